"""Operator 8: n-gram Jaccard join by MinHash banding.

Words are runs without white space; a text's set holds the hashes of its
windows of ``SHINGLE`` words (a shorter text has one window of all its words).
Texts with the same set are one class; only its least id goes on.

``BANDS`` and ``ROWS`` follow from the target recall: a pair of similarity
``THRESHOLD`` meets in one band at least with probability RECALL. Band hashes
are shuffled. A bucket of many texts is cut into blocks by a hash of the id,
and each pair of blocks is a unit of work of its own, so no bucket is one
task's. Within a unit whole signatures are compared and a spanning forest of
what may be similar (an estimate ``MARGIN`` below the threshold) comes out:
never all pairs, however many copies there are.

The forest's components hold every link. Within a component (again in pairs of
blocks) the full n-gram sets are compared, each pair of classes once; what
comes out is each class's number of links and a spanning forest of the links.
Its components are the near-duplicate classes. So no link between different
texts is lost, and no table has a row a link.

Cases: null and empty texts (no words) are alone. Copies and repeated ids are
in one class. A null id stays a row of its own, alone. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, stored, text_slices
from .components import components

SHINGLE, THRESHOLD, RECALL, MARGIN = 5, 0.8, 0.999, 0.12
BLOCK = 128


def banding(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 150) -> tuple[int, int]:
    """Bands and rows: the most rows (so the fewest false candidates) that reach ``recall`` with ``most`` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


BANDS, ROWS = banding()
_MIX = np.random.default_rng(8).integers(1, 1 << 62, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word):
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct window hashes of each text."""
    of = _Hashes().__getitem__
    out = []
    for t in texts:
        words = t.split()
        h = np.fromiter(map(of, words), np.uint64, len(words))
        n = min(SHINGLE, len(h))
        if not n:
            out.append(h)
            continue
        w = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            w = (w ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            w ^= w >> np.uint64(32)
        out.append(np.unique(w))
    return out


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (32 bits) of non-empty sets, a row each."""
    size = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    x = np.concatenate(sets)
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        y = x * _MIX[0, k]
        y += _MIX[1, k]
        out[:, k] = np.minimum.reduceat((y >> np.uint64(32)).astype(np.uint32), starts)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), sign (digest of the set), mins (MinHash values) of every row; nulls without words."""
    def run(batches):
        for ids, texts in text_slices(batches, 4 << 20):
            sets = shingles(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            sign, mins = [None] * len(texts), [None] * len(texts)
            if full:
                for i, row in zip(full, signature([sets[i] for i in full])):
                    sign[i], mins[i] = hashlib.md5(sets[i].tobytes()).digest(), row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(sign, pa.binary()), pa.array(mins, pa.binary())],
                names=["doc_id", "n", "sign", "mins"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n int, sign binary, mins binary")


def _units(rows: DataFrame, key: list[str], size: str) -> DataFrame:
    """Each row once for every pair of blocks that its block is in: columns p <= q, and whether it stands in p or q.

    A group of ``size`` rows has about size / BLOCK blocks.
    """
    blocks = F.ceil(F.col(size) / BLOCK).cast("int")
    rows = rows.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("id", F.lit(8)), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return (rows.select("*", other).withColumns({"p": F.least("_own", "_other"), "q": F.greatest("_own", "_other")})
            .withColumn("left", F.col("_own") == F.col("p")).drop("_blocks", "_other", "_own"))


def _runs(batches, key: list[str]):
    """Rows of sorted batches, whole units at a time."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        columns = [table.column(k).to_numpy() for k in key]
        new = np.zeros(len(table), bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new)
        if len(cuts):
            yield table.slice(0, cuts[-1]), np.concatenate([[0], cuts])
        held = table.slice(cuts[-1]) if len(cuts) else table
    if held is not None and len(held):
        yield held, np.array([0, len(held)])


def _labels(close: np.ndarray) -> np.ndarray:
    """Least member of each row's component under a symmetric matrix."""
    n = len(close)
    label = np.arange(n)
    reach = close | np.eye(n, dtype=bool)
    while True:
        near = np.where(reach, label[None, :], n).min(1)
        near = near[near]
        if (near == label).all():
            return label
        label = near


def _forest(close: np.ndarray, left: np.ndarray, same: bool) -> np.ndarray:
    """Edges (i, j) that connect what ``close`` connects in a unit.

    Between two blocks, what is connected within either block (that block's
    own unit says so) is not said again: a dense group of m texts has about m
    edges, not one for each pair of blocks and text.
    """
    whole = _labels(close)
    part = np.arange(len(close)) if same else _labels(close & (left[:, None] == left[None, :]))
    own = np.flatnonzero(part == np.arange(len(close)))
    own = own[whole[own] != own]
    return np.stack([own, whole[own]], 1)


def _allowed(left: np.ndarray, same: bool) -> np.ndarray:
    """Pairs that a unit answers for: all of its one block, or those between its two blocks, each once."""
    n = len(left)
    return np.triu(np.ones((n, n), bool), 1) if same else left[:, None] & ~left[None, :]


def candidate_forest(reps: DataFrame) -> DataFrame:
    """(a, b): spanning forests of classes that meet in a band and may be similar."""
    width = ROWS * 4
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("mins"), k * width + 1, F.lit(width))))
    rows = reps.select("id", F.explode(bands).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    members = rows.join(sizes, "bucket").join(reps.select("id", "mins"), "id")
    units = _units(members, ["bucket"], "m").repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")

    def run(batches):
        for table, cuts in _runs(batches, ["bucket", "p", "q"]):
            ids = table.column("id").to_numpy()
            p, q, left = table.column("p").to_numpy(), table.column("q").to_numpy(), table.column("left").to_numpy()
            mins = np.frombuffer(b"".join(table.column("mins").to_pylist()), np.uint32).reshape(len(ids), -1)
            out = []
            ends = np.append(cuts[1:], len(ids)) if cuts[-1] != len(ids) else cuts[1:]
            for lo, hi in zip(cuts.tolist(), ends.tolist()):
                if hi - lo < 2:
                    continue
                x = mins[lo:hi]
                close = np.empty((hi - lo, hi - lo), bool)
                for i in range(hi - lo):
                    close[i] = (x == x[i]).mean(1) >= THRESHOLD - MARGIN
                out += [(ids[lo + i], ids[lo + j]) for i, j in _forest(close, left[lo:hi], p[lo] == q[lo])]
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return units.select("bucket", "p", "q", "left", "id", "mins").mapInArrow(run, "a long, b long")


def verified(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b, links): each class's links in a unit (b null), and a spanning forest of the links (links null).

    ``groups``: (id, root, m, copies) of the classes in components of candidates.
    """
    def sets(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = shingles(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("root", "id", "m", "copies")), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["root", "id", "m", "copies", "grams"])

    texts = id_and_text(docs).withColumnRenamed("doc_id", "id").join(groups, "id")
    # Repeated ids: rows of one id and class have one set; the least text stands for it.
    whole = texts.select("root", "id", "m", "copies", "text").mapInArrow(sets, "root long, id long, m long, copies long, grams binary")
    units = _units(whole, ["root"], "m").repartition("root", "p", "q").sortWithinPartitions("root", "p", "q", "id")

    def run(batches):
        for table, cuts in _runs(batches, ["root", "p", "q"]):
            ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
            p, q, left = table.column("p").to_numpy(), table.column("q").to_numpy(), table.column("left").to_numpy()
            grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
            ends = np.append(cuts[1:], len(ids)) if cuts[-1] != len(ids) else cuts[1:]
            a, b, links = [], [], []
            for lo, hi in zip(cuts.tolist(), ends.tolist()):
                if hi - lo < 2:
                    continue
                close = similar(grams[lo:hi], THRESHOLD) & (ids[lo:hi][:, None] != ids[lo:hi][None, :])
                side, same = left[lo:hi], p[lo] == q[lo]
                pairs = close & _allowed(side, same)
                n = pairs @ copies[lo:hi] + copies[lo:hi] @ pairs
                some = np.flatnonzero(n)
                forest = _forest(close, side, same).tolist()
                a += [*ids[lo + some].tolist(), *(int(ids[lo + i]) for i, _ in forest)]
                b += [*[None] * len(some), *(int(ids[lo + j]) for _, j in forest)]
                links += [*n[some].tolist(), *[None] * len(forest)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])

    return units.select("root", "p", "q", "left", "id", "copies", "grams").mapInArrow(run, "a long, b long, links long")


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of ``threshold`` or more, by their full intersections."""
    size = np.array([len(s) for s in sets])
    n, owner = len(sets), np.repeat(np.arange(len(sets)), size)
    names, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.zeros((n, n), np.float64)
    everywhere = times == n
    common += everywhere.sum()
    shared = (times > 1) & ~everywhere
    keep = shared[gram]
    gram, owner = (np.cumsum(shared) - 1)[gram[keep]], owner[keep]
    for at in range(0, int(shared.sum()), 4096):  # a dense piece of the incidence table at a time
        some = (gram >= at) & (gram < at + 4096)
        table = np.zeros((n, 4096), np.float32)
        table[owner[some], gram[some] - at] = 1
        common += table @ table.T
    union = size[:, None] + size[None, :] - common
    return common >= threshold * union - 1e-9


def join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least id of its near-duplicate class), copy_id (least id with the same set) and n_links.

    n_links counts the other documents of similarity ``THRESHOLD`` or more, copies included.
    """
    rows = stored(signatures(docs), "jaccard-signatures")
    classes = stored(rows.where("sign IS NOT NULL AND doc_id IS NOT NULL").groupBy("sign")
                     .agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "jaccard-classes")
    reps = rows.join(classes.select("sign", F.col("id").alias("doc_id")), ["sign", "doc_id"], "left_semi")
    reps = stored(reps.dropDuplicates(["sign"]).select(F.col("doc_id").alias("id"), "mins"), "jaccard-reps")
    maybe = components(stored(candidate_forest(reps), "jaccard-candidates"))
    sizes = maybe.groupBy("root").agg(F.count("*").alias("m"))
    groups = stored(maybe.join(sizes, "root").join(classes.select("id", "copies"), "id").select("id", "root", "m", "copies"), "jaccard-groups")
    links = stored(verified(docs, groups), "jaccard-links")
    near = components(links.where("b IS NOT NULL").select("a", "b"))
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    classes = classes.join(near, "id", "left").join(counts, "id", "left").select(
        "sign", F.col("id").alias("copy_id"), F.coalesce("root", "id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = F.col("sign").isNull() | F.col("doc_id").isNull()
    # Rows alone would all meet in the one key null; they skip the join.
    return (rows.where(~alone).select("doc_id", "sign").join(classes, "sign").select("doc_id", "class_id", "copy_id", "n_links")
            .unionByName(rows.where(alone).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each near-duplicate class: its least id, ids that name one row before others.

    Rows are judged one by one: those without an id, or of an id that several
    rows have, get numbers of their own above all ids. Rows without words all stay.
    """
    own = F.col("doc_id").cast("long")
    again = stored(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("m")).where("m > 1").select("doc_id"), "jaccard-again")
    unclear = docs.join(again, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    top = docs.agg(F.coalesce(F.max(own), F.lit(0)).alias("_top"))
    numbered = stored(unclear.select(*docs.columns).withColumn("_row", F.monotonically_increasing_id()), "jaccard-rows")
    keyed = numbered.crossJoin(F.broadcast(top)).withColumn("_key", F.col("_top") + 1 + F.col("_row"))  # one row
    keyed = docs.where("doc_id IS NOT NULL").join(again, "doc_id", "left_anti").select(*docs.columns, own.alias("_key")).unionByName(keyed.select(*docs.columns, "_key"))
    gone = stored(join(keyed.select(F.col("_key").alias("doc_id"), "text")).where("doc_id <> class_id").select(F.col("doc_id").alias("_key")), "jaccard-gone")
    return keyed.join(gone, "_key", "left_anti").select(*docs.columns)


#: The same result by brute force over all shared n-grams, for DuckDB.
ORACLE = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f\v]+'), lambda x: x <> '') as w from documents),
grams as (
  select doc_id, list_sort(list_distinct(case
    when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as g from words),
classes as (select g, min(doc_id) as copy_id, count(*) as copies from grams where len(g) > 0 group by g),
singles as (select copy_id as id, len(g) as n, unnest(g) as s from classes),
shared as (select a.id as a, b.id as b, count(*) as n_both, any_value(a.n) as na, any_value(b.n) as nb
           from singles a join singles b on a.s = b.s and a.id < b.id group by 1, 2),
links as (select a, b from shared where 5 * n_both >= 4 * (na + nb - n_both)),
sides as (select a as id, b as other from links union all select b, a from links),
reach as (select id, id as root from (select distinct id from sides)
          union select s.other, r.root from reach r join sides s on s.id = r.id),
roots as (select id, min(root) as class_id from reach group by id),
counted as (select s.id, sum(c.copies) as links from sides s join classes c on c.copy_id = s.other group by s.id),
member as (
  select g.doc_id, c.copy_id, coalesce(r.class_id, c.copy_id) as class_id,
         cast(coalesce(k.links, 0) + c.copies - 1 as bigint) as n_links
  from grams g join classes c on c.g = g.g left join roots r on r.id = c.copy_id left join counted k on k.id = c.copy_id)
select doc_id, class_id, copy_id, n_links from member
union all
select doc_id, doc_id, doc_id, cast(0 as bigint) from grams where len(g) = 0
"""
