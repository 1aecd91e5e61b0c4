"""Operator 4: removal of repeated byte strings, by prefix-free parsing.

A rolling hash of ``GRAM`` bytes sets triggers: every string of ``LENGTH``
bytes has one, its least gram (leftmost on ties). All strings with one trigger
in a row form a phrase: the bytes around that trigger, at most 2 x LENGTH -
GRAM of them. Triggers and phrases depend on content only, so equal strings
lie at the same place of phrases with the same trigger gram. The parse of the
corpus is its list of phrases, the dictionary its different phrases.

Corpus order (which strings are equal) follows in two steps instead of one
sort of all suffixes. Parse: a phrase that occurs twice makes all its strings
repeats. Dictionary: of phrases with a shared trigger that differ (at the
edges of repeats), one of each is cut into its strings, whose hashes are
compared across the dictionary. A repeat longer than a phrase thus costs one
row a phrase, and only edges are looked at byte by byte.

Two bitmaps of fixed size (16 MB) keep what cannot matter from being shuffled:
one of repeated triggers, one of the texts that take part. They only filter;
exact counts follow. Strings are equal if 64-bit hashes of all their bytes
and of their trigger agree.

Cases: null and empty texts are 0 bytes and keep 0. A text shorter than
LENGTH keeps all. Repeated rows repeat each other, so texts of LENGTH or more
lose all bytes. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import stored
from .postings import get_varints, put_varints

LENGTH, GRAM = 200, 64
FILTER_BITS = 27
BUFFER = 1 << 20
STRINGS_PER_BUCKET = 1_000_000

_POSITION = np.uint64(BUFFER - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = _powers(_BASE, BUFFER + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), BUFFER + 1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


class Rolling:
    """Hashes of all substrings of a buffer."""

    def __init__(self, data: np.ndarray):
        x = _BYTES[data]
        x *= _UP[:len(x)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * _DOWN[:n])

    def some(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _DOWN[start])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    block = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    block[:len(x)] = x
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def phrases(data: np.ndarray, owner: np.ndarray):
    """(start, last, trigger, key, phrase): runs of strings with one trigger, within one owner each."""
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    rolling = Rolling(data)
    gram = rolling.every(GRAM)
    at = sliding_least((gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64), LENGTH - GRAM + 1) & _POSITION
    at = np.where(owner[:len(at)] == owner[LENGTH - 1:], at.astype(np.int64), -1)
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([cut[1:], [len(at)]]) - 1
    ok = at[cut] >= 0
    start, last = cut[ok], last[ok]
    trigger = at[start]
    shape = ((last - start).astype(np.uint64) << np.uint64(20)) | (trigger - start).astype(np.uint64)
    return start, last, gram[trigger], rolling.some(start, last + LENGTH) ^ mix(shape)


def buffers(texts: list[bytes]):
    """Pieces of texts, put together to buffers: (data, owner of each byte, owners' places in the data and in their texts).

    Longer texts are cut so that each string lies in one piece.
    """
    pieces, held = [], 0
    for i, t in enumerate(texts):
        step = BUFFER - LENGTH + 1
        for at in range(0, max(len(t) - LENGTH + 1, 0), step):
            piece = t[at:at + BUFFER]
            if held + len(piece) > BUFFER:
                yield _buffer(pieces)
                pieces, held = [], 0
            pieces.append((i, at, piece))
            held += len(piece)
    if pieces:
        yield _buffer(pieces)


def _buffer(pieces):
    size = np.array([len(p) for _, _, p in pieces])
    data = np.frombuffer(b"".join([p for _, _, p in pieces]), np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    return data, np.repeat(np.arange(len(pieces)), size), begin, np.array([i for i, _, _ in pieces]), np.array([a for _, a, _ in pieces])


def _slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(column))))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        n = max(1, int(np.searchsorted(sizes[at:], done + limit, side="right")))
        yield batch.slice(at, n)
        at += n


def _bit(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = key >> np.uint64(64 - FILTER_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame) -> bytes:
    """A bitmap of column ``key`` (hashes): 2 ** FILTER_BITS bits, whatever the number of keys."""
    page = 16
    bits = keys.select(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("bit"))

    def pack(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << page, np.uint8)
        places = table.column("bit").to_numpy()
        flags[places & ((1 << page) - 1)] = 1
        return pa.table({"page": [int(places[0]) >> page], "bits": [np.packbits(flags, bitorder="little").tobytes()]},
                        schema=pa.schema([("page", pa.int64()), ("bits", pa.binary())]))

    pages = bits.distinct().groupBy(F.shiftright("bit", page)).applyInArrow(pack, "page long, bits binary").collect()
    out = bytearray(1 << (FILTER_BITS - 3))
    size = 1 << (page - 3)
    for p, b in pages:  # 2 ** 11 pages of 8 KB at most
        out[p * size:(p + 1) * size] = b
    return bytes(out)


def source(docs: DataFrame) -> DataFrame:
    """doc_id, sign (hash of the bytes: ids may repeat), body (bytes)."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), body).alias("sign"), body.alias("body"))


_PHRASE = "key long, phrase long, sign long, start int, last int"


def parse(rows: DataFrame, bits=None) -> DataFrame:
    """The phrases of all texts; with ``bits``, those whose trigger may be repeated."""
    def run(batches):
        seen = np.frombuffer(bits.value, np.uint8) if bits is not None else None
        for batch in batches:
            for part in _slices(batch, "body"):
                signs = part.column("sign").to_numpy()
                for data, owner, begin, index, offset in buffers(part.column("body").to_pylist()):
                    start, last, key, phrase = phrases(data, owner)
                    if seen is not None:
                        keep = _bit(key, seen)
                        start, last, key, phrase = start[keep], last[keep], key[keep], phrase[keep]
                    of = owner[start]
                    shift = offset[of] - begin[of]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(phrase.view(np.int64)), pa.array(signs[index[of]]),
                         pa.array((start + shift).astype(np.int32)), pa.array((last + shift).astype(np.int32))],
                        names=["key", "phrase", "sign", "start", "last"])

    return rows.where(F.length("body") >= LENGTH).select("sign", "body").mapInArrow(run, _PHRASE)


def _share(rows: DataFrame, data: bytes):
    return rows.sparkSession.sparkContext.broadcast(data)  # 16 MB


def with_places(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Texts joined with their places (sign, places); texts that have none stay out of the shuffle."""
    bits = _share(rows, bitmap(places.select(F.col("sign").alias("key"))))

    def run(batches):
        seen = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(_bit(batch.column("sign").to_numpy().view(np.uint64), seen)))

    return rows.mapInArrow(run, "doc_id long, sign long, body binary").join(places, "sign")


def dictionary_repeats(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """(sign, start, last): runs of strings of dictionary entries that occur in another entry too.

    ``entries``: (sign, start, last), one place for each different phrase.
    """
    total = entries.agg(F.sum(F.col("last") - F.col("start") + 1)).first()[0] or 0
    top = max(4, int(np.ceil(np.log2(max(total / STRINGS_PER_BUCKET, 1)))))
    places = stored(entries.groupBy("sign").agg(F.sort_array(F.collect_list(F.struct("start", "last"))).alias("places")), "dedup-places")
    texts = (with_places(rows.select("doc_id", "sign", "body"), places).dropDuplicates(["sign"]).select("sign", "body", "places").sortWithinPartitions("sign"))
    schema = "bucket long, pack long, strings binary, gaps binary, entries binary"

    def cut(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows_ in _slices(batch, "body"):
                hashes, signs, starts, sizes = [], [], [], []
                for sign, body, spans in zip(rows_.column("sign").to_pylist(), rows_.column("body").to_pylist(), rows_.column("places").to_pylist()):
                    data = np.frombuffer(body, np.uint8)
                    for s in spans:
                        hashes.append(Rolling(data[s["start"]:s["last"] + LENGTH]).every(LENGTH))
                        signs.append(sign)
                        starts.append(s["start"])
                        sizes.append(s["last"] - s["start"] + 1)
                v = np.concatenate(hashes)
                bucket = (v >> np.uint64(64 - top)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                names, first = np.unique(bucket[order], return_index=True)
                ends = np.append(first[1:], len(v))
                pack, k = (part << 32) | k, k + 1
                index = np.array([signs, starts, sizes], np.int64).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*names.tolist(), -1 - pack]), pa.array([pack] * (len(names) + 1)),
                     pa.array([*(v[order[a:b]].tobytes() for a, b in zip(first, ends)), None], pa.binary()),
                     pa.array([*(put_varints(np.diff(order[a:b], prepend=0))[0].tobytes() for a, b in zip(first, ends)), None], pa.binary()),
                     pa.array([None] * len(names) + [index], pa.binary())], names=["bucket", "pack", "strings", "gaps", "entries"])

    def compare(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["pack", "gaps", "entries"])
        parts = [np.frombuffer(x, np.uint64) for x in table.column("strings").to_pylist()]
        v = np.concatenate(parts)
        order = np.argsort(v, kind="stable")
        same = v[order][1:] == v[order][:-1]
        twice = np.zeros(len(v), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        out, at = [], 0
        for x, gaps in zip(parts, table.column("gaps").to_pylist()):
            index = np.cumsum(get_varints(np.frombuffer(gaps, np.uint8))[0])[twice[at:at + len(x)]]
            out.append(put_varints(np.diff(index, prepend=0))[0].tobytes())
            at += len(x)
        return pa.table([table.column("pack"), pa.array(out, pa.binary()), pa.nulls(len(out), pa.binary())], names=["pack", "gaps", "entries"])

    def runs(table: pa.Table) -> pa.Table:
        found, entry = [np.zeros(0, np.int64)], None
        for gaps, index in zip(table.column("gaps").to_pylist(), table.column("entries").to_pylist()):
            if index is not None:
                entry = np.frombuffer(index, np.int64).reshape(3, -1)
            else:
                found.append(np.cumsum(get_varints(np.frombuffer(gaps, np.uint8))[0]))
        at = np.sort(np.concatenate(found))
        begin = np.concatenate([[0], np.cumsum(entry[2])[:-1]])
        of = np.searchsorted(begin, at, side="right") - 1
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])]) if len(at) else np.zeros(0, bool)
        a, b = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(at)) - 1
        start = entry[1][of[a]] + at[a] - begin[of[a]]
        return pa.table([pa.array(entry[0][of[a]]), pa.array(start.astype(np.int32)), pa.array((start + at[b] - at[a]).astype(np.int32))] if len(at) else
                        [pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int32())], names=["sign", "start", "last"])

    flagged = texts.mapInArrow(cut, schema).groupBy("bucket").applyInArrow(compare, "pack long, gaps binary, entries binary")
    return flagged.groupBy("pack").applyInArrow(runs, "sign long, start int, last int")


def repeats(rows: DataFrame) -> DataFrame:
    """(sign, start, last): runs of starts of repeated strings."""
    twice = parse(rows).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = stored(parse(rows, _share(rows, bitmap(twice))), "dedup-parse")
    entry = found.groupBy("key", "phrase").agg(F.count("*").alias("n"), F.min(F.struct("sign", "start", "last")).alias("one"))
    entry = stored(entry, "dedup-dictionary")
    # Whole phrases that occur twice.
    whole = found.join(entry.where("n > 1").select("key", "phrase"), ["key", "phrase"], "left_semi").select("sign", "start", "last")
    # Triggers with phrases that occur once and other phrases beside them.
    mixed = entry.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("key")
    edges = entry.join(mixed, "key", "left_semi").select("one.*")
    return whole.unionByName(dictionary_repeats(rows, stored(edges, "dedup-edges")))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of every row."""
    rows = source(docs)
    places = stored(repeats(rows).groupBy("sign").agg(F.collect_list(F.struct("start", "last")).alias("places")), "dedup-repeats")
    bits = _share(rows, bitmap(places.select(F.col("sign").alias("key"))))

    def side(wanted: bool):
        def run(batches):
            seen = np.frombuffer(bits.value, np.uint8)
            for batch in batches:
                flag = _bit(batch.column("sign").to_numpy().view(np.uint64), seen)
                yield batch.filter(pa.array(flag if wanted else ~flag))
        return run

    def remove(batches):
        for batch in batches:
            for part in _slices(batch, "body"):
                n_removed, n_spans, kept = [], [], []
                for body, spans in zip(part.column("body").to_pylist(), part.column("places").to_pylist()):
                    edge = np.zeros(len(body) + 1, np.int64)
                    if spans:
                        np.add.at(edge, [s["start"] for s in spans], 1)
                        np.add.at(edge, [s["last"] + LENGTH for s in spans], -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    n_removed.append(int(gone.sum()))
                    n_spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                    kept.append(np.frombuffer(body, np.uint8)[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pc.binary_length(part.column("body")).cast(pa.int64()),
                     pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    shape, out = "doc_id long, sign long, body binary", "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    touched = rows.mapInArrow(side(True), shape).join(places, "sign", "left").select("doc_id", "body", "places").mapInArrow(remove, out)
    rest = rows.mapInArrow(side(False), shape).select(
        "doc_id", F.length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("body").alias("kept"))
    return touched.unionByName(rest)
