"""Block postings: which texts of a block hold a unit, and how often, in few bytes.

A block is what one Python step holds: at most ``BLOCK_DOCS`` texts and about
``block_bytes`` of text. For each unit (a word, a character n-gram) of a block
there is one row with the positions of its texts and the counts there, as
variable-length integers. So a corpus reaches the join with its model table in
about a third of its compressed size, a unit that is in every text has one row
a block and no key is hot, and a join on units gives every text's sum without
moving a text.

Sums are of integers (thousandths), so they do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import give_back

#: Texts, and bytes of text, of a block; a step holds about 30 times these bytes.
BLOCK_DOCS = 8192
BLOCK_BYTES = 5 << 20
SCALE = 1000
#: Unit of the row that names a block's texts; no unit of a text has it.
INDEX_TEXT, INDEX_NUMBER = "", -1


def put_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as 7-bit groups, lowest first; and each one's end offset."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        more = v >= np.uint64(1 << (7 * k)) if k < 10 else None
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(v) else 0, np.uint8)
    starts = ends - size
    for k in range(int(size.max()) if len(v) else 0):
        has = size > k
        out[starts[has] + k] = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | np.where(size[has] > k + 1, 128, 0).astype(np.uint8)
    return out, ends


def get_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of ``data`` and the offset where each ends."""
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    size = ends - starts
    out = (data[starts] & 127).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    for k in range(1, int(size.max()) if len(size) else 0):
        has = size > k
        out[has] |= (data[starts[has] + k] & 127).astype(np.int64) << (7 * k)
    return out, ends


def zigzag(v: np.ndarray) -> np.ndarray:
    return (v << 1) ^ (v >> 63)


def unzigzag(v: np.ndarray) -> np.ndarray:
    return (v >> 1) ^ -(v & 1)


def pair_counts(unit: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences (unit, text) to the distinct pairs, as sorted numbers unit << 13 | text, and how often each occurs."""
    key = unit.astype(np.uint64)
    key <<= np.uint64(13)
    key |= doc.astype(np.uint16)
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.concatenate([first, [len(key)]]))


def pack_pairs(unit: np.ndarray, doc: np.ndarray, bits: int = 1) -> tuple[np.ndarray, pa.Array]:
    """Occurrences (unit, text) to the distinct units and, for each, its binary postings."""
    return pack_counts(*pair_counts(unit, doc), bits)


def pack_counts(key: np.ndarray, count: np.ndarray, bits: int = 1) -> tuple[np.ndarray, pa.Array]:
    """Counted pairs (see ``pair_counts``) to the distinct units and, for each, its binary postings.

    Counts below 2 ** ``bits`` share a number with their gap: 3 where units
    are frequent (short gaps, many counts), 1 where they are rare.
    """
    unit, doc = (key >> np.uint64(13)).astype(np.int64), (key & np.uint64(8191)).astype(np.int64)
    new = np.concatenate([[True], unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, bool)
    unit = unit[new]
    gap = np.where(new, doc, doc - np.concatenate([[0], doc[:-1]])) if len(doc) else doc
    del doc
    # Of each unit: its number of texts (and bits), then gaps with counts, then the rest of large counts.
    top = 1 << bits
    row, more = np.cumsum(new) - 1, count >= top
    rows = len(unit)
    texts, many = np.bincount(row, minlength=rows), np.bincount(row[more], minlength=rows)
    start = np.cumsum(1 + texts + many) - (1 + texts + many)
    values = np.zeros(int((1 + texts + many).sum()), np.int64)
    values[start] = texts * 2 + (bits == 3)
    place = np.arange(len(row)) - (np.cumsum(texts) - texts)[row]
    values[start[row] + 1 + place] = gap * top + np.minimum(count, top) - 1
    del place, gap
    at = np.arange(int(more.sum())) - (np.cumsum(many) - many)[row[more]]
    values[start[row[more]] + 1 + texts[row[more]] + at] = count[more] - top
    del row, more, at
    data, ends = put_varints(values)
    offsets = np.concatenate([[0], ends[start[1:] - 1], ends[-1:]]).astype(np.int32) if rows else np.zeros(1, np.int32)
    post = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return unit, post


def unpack_pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, text, count) of a column of binary postings."""
    column = pa.concat_arrays([column])  # offsets from 0
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    values, ends = get_varints(data)
    row = np.searchsorted(offsets[1:] - offsets[0], ends, side="left")
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    head = np.repeat(values[first], np.diff(np.append(first, len(row))))
    texts = head >> 1
    is_gap = (place > 0) & (place <= texts)
    coded, of = values[is_gap], row[is_gap]
    bits = np.where(head[is_gap] & 1, 3, 1)
    count = (coded & ((1 << bits) - 1)) + 1
    count[count == 1 << bits] += values[place > texts]
    gap = coded >> bits
    total = np.cumsum(gap)
    new = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of, total - np.repeat((total - gap)[new], np.diff(np.append(new, len(of)))), count


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to blocks; the second column is the text."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0))
        start = 0
        while start < len(sizes):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[start:start + BLOCK_DOCS]), size, side="right")))
            yield batch.slice(start, n)
            start += n


def block_postings(docs: DataFrame, unit_type: str, units: Callable[[list[str]], tuple[np.ndarray, np.ndarray, Callable]],
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block, unit, post, ids, langs): postings, and one index row a block with its texts' ids and languages.

    ``units(texts)`` gives number and text of each occurrence, and a function
    from distinct numbers to the units themselves.
    """
    index = INDEX_TEXT if unit_type == "string" else INDEX_NUMBER

    def run(batches):
        from pyspark import TaskContext

        kind = pa.string() if unit_type == "string" else pa.int64()
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(blocks(batches, block_bytes)):
            block, texts = (part << 32) | k, batch.column(1).to_pylist()
            number, doc, name = units(texts)
            # One step at a time: what a step read is gone before the next.
            number, count = pair_counts(number, doc)
            del doc
            number, post = pack_counts(number, count, 1 if unit_type == "string" else 3)
            found = pa.array(name(number), type=kind)
            n = len(found)
            for at in range(0, n, 20_000):
                m = min(20_000, n - at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), found.slice(at, m), post.slice(at, m),
                     pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.list_(pa.string()))],
                    names=["block", "unit", "post", "ids", "langs"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([index], type=kind), pa.nulls(1, pa.binary()),
                 pa.array([batch.column(0).to_pylist()], type=pa.list_(pa.int64())),
                 pa.array([batch.column(2).to_pylist()], type=pa.list_(pa.string()))],
                names=["block", "unit", "post", "ids", "langs"])
            del number, count, name, post, found
        give_back()

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
    ).mapInArrow(run, f"block long, unit {unit_type}, post binary, ids array<long>, langs array<string>")


def index_rows(postings: DataFrame) -> DataFrame:
    """One row a text: block, pos, doc_id, lang."""
    return (postings.where("ids IS NOT NULL")
            .select("block", F.posexplode(F.arrays_zip("ids", "langs")))
            .select("block", "pos", F.col("col.ids").alias("doc_id"), F.col("col.langs").alias("lang")))


def marks(chosen: DataFrame) -> DataFrame:
    """(block, pos, group) to one bitmap a block and group: 1 KB at most for each."""
    @F.pandas_udf("binary")
    def bits(column):
        def one(positions):
            flags = np.zeros(BLOCK_DOCS, np.uint8)
            flags[np.asarray(positions)] = 1
            return np.packbits(flags).tobytes()
        return column.map(one)

    return (chosen.groupBy("block").pivot("group", ["a", "b"]).agg(F.collect_set("pos"))
            .select("block", bits(F.coalesce("a", F.array().cast("array<int>"))).alias("a"),
                    bits(F.coalesce("b", F.array().cast("array<int>"))).alias("b")))


def marked_counts(postings: DataFrame, bitmaps: DataFrame, unit_type: str) -> DataFrame:
    """(unit, a, b): occurrences of each unit in the texts marked a and b."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            row, doc, count = unpack_pairs(batch.column("post"))
            out = []
            for name in ("a", "b"):
                coded = batch.column(name).dictionary_encode()
                flags = np.stack([np.unpackbits(np.frombuffer(x, np.uint8)) for x in coded.dictionary.to_pylist()])
                which = np.asarray(coded.indices)[row]
                out.append(np.bincount(row, flags[which, doc] * count, batch.num_rows).astype(np.int64))
            some = (out[0] + out[1]) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("unit").filter(pa.array(some)), pa.array(out[0][some]), pa.array(out[1][some])], names=["unit", "a", "b"])

    rows = postings.where("ids IS NULL").select("block", "unit", "post").join(bitmaps, "block")
    return (rows.mapInArrow(run, f"unit {unit_type}, a long, b long")
            .groupBy("unit").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def doc_sums(postings: DataFrame, scored: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, lang, n (occurrences) and, for each of ``names``, the sum of count x value over a text's units.

    ``scored``: posting rows (block, post) with one value column a name.
    Two steps: each task adds up what it holds of a block, then what the tasks
    have of a block meets; a block has no more of it than it has text.
    """
    values = [F.round(F.col(x) * SCALE).cast("long").alias(x) for x in names]
    k = len(names) + 1

    def part(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            row, doc, count = unpack_pairs(batch.column("post"))
            blocks_, which = np.unique(np.asarray(batch.column("block")), return_inverse=True)
            slot = which[row] * BLOCK_DOCS + doc
            slots, at = np.unique(slot, return_inverse=True)
            sums = [np.bincount(at, count, len(slots)).astype(np.int64)]
            for name in names:
                v = np.asarray(batch.column(name))
                total = np.zeros(len(slots), np.int64)
                np.add.at(total, at, v[row] * count)
                sums.append(total)
            of = slots // BLOCK_DOCS
            cuts = np.searchsorted(of, np.arange(len(blocks_) + 1))
            posts = []
            for i in range(len(blocks_)):
                lo, hi = cuts[i], cuts[i + 1]
                pos = slots[lo:hi] % BLOCK_DOCS
                cols = [np.diff(pos, prepend=0), *(zigzag(s[lo:hi]) for s in sums)]
                posts.append(put_varints(np.stack(cols, 1).ravel())[0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks_), pa.array(posts, type=pa.binary())], names=["block", "part"])

    def whole(table: pa.Table) -> pa.Table:
        total = np.zeros((BLOCK_DOCS, k), np.int64)
        ids = langs = []
        for part_, i, l in zip(table.column("part").to_pylist(), table.column("ids").to_pylist(), table.column("langs").to_pylist()):
            if i is not None:
                ids, langs = i, l
            else:
                v = get_varints(np.frombuffer(part_, np.uint8))[0].reshape(-1, k + 1)
                total[np.cumsum(v[:, 0])] += unzigzag(v[:, 1:])
        n = len(ids)
        return pa.table([pa.array(ids, type=pa.int64()), pa.array(langs, type=pa.string()), *(pa.array(total[:n, j]) for j in range(k))],
                        names=["doc_id", "lang", "n", *names])

    # Rows of a block side by side, so that a task adds up most of a block at once.
    parts = (scored.select("block", "post", *values).sortWithinPartitions("block")
             .mapInArrow(part, "block long, part binary")
             .withColumns({"ids": F.lit(None).cast("array<long>"), "langs": F.lit(None).cast("array<string>")}))
    index = postings.where("ids IS NOT NULL").select("block", F.lit(None).cast("binary").alias("part"), "ids", "langs")
    out = parts.unionByName(index).groupBy("block").applyInArrow(
        whole, "doc_id long, lang string, n long, " + ", ".join(f"{x} long" for x in names))
    return out.withColumns({x: F.col(x) / SCALE for x in names})
