"""SimHash near-duplicates: a binary trie of fingerprints joined with itself.

A text's fingerprint has a bit set if over half of its word shingles' hashes
have it. Texts whose fingerprints differ in at most ``BUDGET`` bits are linked;
linked texts are one component. Copies of one fingerprint are one class: the
join works on classes only.

The join walks pairs of trie nodes together, from the root down, bit by bit. A
pair carries the bits in which its two nodes differ so far and is dropped as
soon as these exceed the budget; pairs of few leaves are compared directly, and
pairs whose leaves are all linked with each other already are dropped too. The
walk is spread over the cluster by subtrees: the 64 bits are cut into five
blocks, and three differing bits leave at least two blocks equal, so ten
orders of the bits (two blocks first) put both ends of any link under one node
of one of ten tries, at 25 or 26 bits' depth. Each such subtree is walked in one
task. A subtree with more than ``LEAVES`` leaves is cut into the node pairs
``STEP`` bits further down, each with its differing bits, and those are dealt out
again until all are small; no leaf pair is listed for that.

A walk gives a forest of each subtree's links, never all pairs. Components come
from the forests by least labels, in tables in the shared folder.

Odd input: null texts are empty; a text without words has fingerprint zero, and
one with fewer words than a shingle has its words as the only shingle. Rows with
a null id get a fingerprint and their component's least id, null where no row of
the component has one. Repeated rows each get a row. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import give_back, id_and_text, stored
from .components import components

#: Words of a shingle, and the seed of its hash.
SHINGLE, SEED = 3, 42
#: Bits in which linked fingerprints may differ.
BUDGET = 3
#: Widths of the blocks that the 64 bits are cut into, lowest first.
BLOCKS = (13, 13, 13, 13, 12)
#: Leaves of a subtree that one walk takes, and bits by which a larger one is cut further down.
LEAVES, STEP = 1 << 16, 4
#: Leaf pairs of a node pair up to which they are compared directly, and node pairs held in one step.
DIRECT, WIDE = 24, 1 << 17
#: Bytes of text whose words are held at a time.
SEGMENT = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# -- fingerprints

def _words(data: bytes) -> Iterator[list[bytes]]:
    """Lists of lower-case words; long texts are cut between words."""
    start = 0
    while start < len(data):
        end = start + SEGMENT
        if end < len(data):
            found = _SPACE.search(data, end)
            end = found.start() if found else len(data)
        yield data[start:end].lower().split()  # bytes: letters A-Z and ASCII white space only
        start = end


def fingerprint(data: bytes) -> int:
    """The fingerprint of a text in UTF-8."""
    digest, ones, total, held = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for words in _words(data):
        held += words
        if len(held) >= SHINGLE:
            shingles = zip(*(held[i:] for i in range(SHINGLE)))
            hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], np.uint64)
            for part in np.split(hashes, range(1 << 16, len(hashes), 1 << 16)):
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
            held = held[-(SHINGLE - 1):]
    if not total:
        if not held:
            return 0
        return digest(b" ".join(held), SEED)  # more than half of one hash: its own bits
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every text; ``fp`` holds the 64 bits as a long."""

    def run(batches):
        try:
            for batch in batches:
                texts = batch.column(1).cast(pa.binary())
                found = np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])
        finally:
            give_back()

    return id_and_text(docs).mapInArrow(run, "doc_id long, fp long")


# -- the walk

def _split(lo: np.ndarray, hi: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Where the set bit starts in each range: zeros come first, as leaves are sorted."""
    return hi - (ones[hi] - ones[lo])


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of each i and j; a component's label is its first leaf."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def _compare(leaves: np.ndarray, pairs: tuple, label: np.ndarray, budget: int) -> None:
    """Link the leaves of small node pairs."""
    a, a_end, b, b_end, err = pairs
    width = b_end - b
    count = (a_end - a) * width
    which = np.repeat(np.arange(len(a)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    i, j = a[which] + at // width[which], b[which] + at % width[which]
    near = np.bitwise_count(leaves[i] ^ leaves[j]) <= budget
    _hook(label, i[near], j[near])


def walk(leaves: np.ndarray, bits: int, pairs: tuple, budget: int = BUDGET) -> np.ndarray:
    """Label (first linked leaf) of every leaf; ``pairs`` are ranges of sorted leaves under nodes ``bits`` above them.

    ``pairs`` = (start, end, start, end, errors): a node with itself, or two nodes
    whose errors, the bits that differ above, are given. Leaves are the whole
    numbers that the last comparison counts differing bits of.
    """
    label = np.arange(len(leaves))
    stack = [(bits, pairs)]
    ones_at: dict[int, np.ndarray] = {}
    while stack:
        depth, pairs = stack.pop()
        if len(pairs[0]) > WIDE:
            half = len(pairs[0]) // 2
            stack += [(depth, tuple(p[:half] for p in pairs)), (depth, tuple(p[half:] for p in pairs))]
            continue
        # Leaves of one component need no more links.
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        a, a_end, b, b_end, err = pairs
        done = (change[a_end - 1] == change[a]) & (change[b_end - 1] == change[b]) & (label[a] == label[b])
        pairs = tuple(p[~done] for p in pairs)
        a, a_end, b, b_end, err = pairs
        small = (a_end - a) * (b_end - b) <= DIRECT
        if depth == 0:
            small[:] = True
        if small.any():
            _compare(leaves, tuple(p[small] for p in pairs), label, budget)
            a, a_end, b, b_end, err = (p[~small] for p in pairs)
        if not len(a):
            continue
        if depth - 1 not in ones_at:
            ones_at[depth - 1] = np.concatenate([[0], np.cumsum((leaves >> np.uint64(depth - 1)) & np.uint64(1), dtype=np.int64)])
        ones = ones_at[depth - 1]
        am, bm, same = _split(a, a_end, ones), _split(b, b_end, ones), a == b
        kids = [(a, am, b, bm, err), (am, a_end, bm, b_end, err), (a, am, bm, b_end, err + 1),
                tuple(x[~same] for x in (am, a_end, b, bm, err + 1))]  # a node with itself has one mixed pair
        kids = tuple(np.concatenate(x) for x in zip(*kids))
        keep = (kids[1] > kids[0]) & (kids[3] > kids[2]) & (kids[4] <= budget) & ~((kids[0] == kids[2]) & (kids[1] - kids[0] == 1))
        if keep.any():
            stack.append((depth - 1, tuple(k[keep] for k in kids)))
    return label


def _tree_links(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tree of few links a leaf for each component: the k-th member to the (k - 1) // 2-th."""
    order = np.argsort(label, kind="stable")
    first = np.concatenate([[True], label[order][1:] != label[order][:-1]]) if len(order) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    rank = np.arange(len(order)) - begin
    child = np.flatnonzero(rank > 0)
    return order[child], order[begin[child] + (rank[child] - 1) // 2]


_PIECE = "piece binary, depth int, err int, side int, crossed boolean, leaf long, fp long"
_WALKED = "hot boolean, " + _PIECE + ", a long, b long"


def _walk_pieces(leaf_limit: int):
    """Task over rows sorted by piece, side and leaf: links of small pieces, the rows of larger ones as they came."""
    names = [c.split()[0] for c in _WALKED.split(", ")]

    def links(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(tables)
        if not rows.num_rows:
            return
        piece = pa.concat_arrays(rows.column("piece").chunks).dictionary_encode().indices.to_numpy()
        depth, err, side = (rows.column(c).to_numpy() for c in ("depth", "err", "side"))
        leaf, fp = rows.column("leaf").to_numpy().view(np.uint64), rows.column("fp").to_numpy()
        start = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        end = np.append(start[1:], len(piece))
        halves = np.concatenate([[0], np.cumsum(side)])
        middle = end - (halves[end] - halves[start])  # the second side follows the first
        lone = ~rows.column("crossed").to_numpy()[start]  # a node with itself
        use = np.where(lone, end - start > 1, (middle > start) & (middle < end))
        for level in np.unique(depth[start[use]]):
            at = use & (depth[start] == level)
            a, b = start[at], np.where(lone, start, middle)[at]
            label = walk(leaf, int(level), (a, np.where(lone, end, middle)[at], b, end[at], err[a].astype(np.int64)))
            child, parent = _tree_links(label)
            if len(child):
                null = [pa.nulls(len(child), t) for t in (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(child), bool)), *null, pa.array(fp[child]), pa.array(fp[parent])], names=names)

    def hot(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.to_batches():
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, bool)), *batch.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)

    def run(batches):
        ready, held, open_rows, key, passing = [], 0, [], None, False  # finished pieces; rows of the piece under way
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                table, cuts = pa.Table.from_batches([batch]), _cuts(batch.column(0))
                first = batch.column(0)[0].as_py()
                if first != key:
                    ready, held = ready + open_rows, held + sum(t.num_rows for t in open_rows)
                    open_rows, passing = [], False
                if len(cuts) > 1:  # the piece under way ends here, and others may lie within
                    runs = np.diff(cuts)
                    runs[0] += sum(t.num_rows for t in open_rows)
                    large = (runs > leaf_limit) & (batch.column(1).to_numpy()[cuts[:-1]] > 0)
                    large[0] |= passing
                    if large.any():
                        rows = np.repeat(large, np.diff(cuts))
                        done = table.slice(0, cuts[-1])
                        if large[0]:
                            for t in open_rows:
                                yield from hot(t)
                            open_rows = []
                        yield from hot(done.filter(pa.array(rows)))
                        done = done.filter(pa.array(~rows))
                    else:
                        done = table.slice(0, cuts[-1])
                    ready, held = [*ready, *open_rows, done], held + done.num_rows + sum(t.num_rows for t in open_rows)
                    open_rows, passing = [], False
                if held >= leaf_limit:
                    yield from links(ready)
                    ready, held = [], 0
                key = batch.column(0)[cuts[-1]].as_py()
                open_rows.append(table.slice(cuts[-1]))
                if passing or sum(t.num_rows for t in open_rows) > leaf_limit and batch.column(1)[cuts[-1]].as_py() > 0:
                    passing = True
                    for t in open_rows:
                        yield from hot(t)
                    open_rows = []
            ready += open_rows
            if ready:
                yield from links(ready)
        finally:
            give_back()

    return run


def _cuts(piece: pa.Array) -> list[int]:
    """Starts of the runs of equal values."""
    differ = pc.not_equal(piece.slice(1), piece.slice(0, len(piece) - 1)).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(differ) + 1).tolist()]


def _subtrees(classes: DataFrame) -> DataFrame:
    """Every fingerprint under its subtree in each of the ten tries: two blocks name it, the others are the leaf's bits."""
    starts = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]

    def joined(picked):
        value, width = F.lit(0).cast("long"), 0
        for i in picked:
            block = F.shiftrightunsigned("fp", starts[i]).bitwiseAND(F.lit((1 << BLOCKS[i]) - 1))
            value, width = F.shiftleft(value, BLOCKS[i]).bitwiseOR(block), width + BLOCKS[i]
        return value, width

    entries = []
    for i in range(len(BLOCKS)):
        for j in range(i):
            top, _ = joined([i, j])
            leaf, depth = joined([k for k in range(len(BLOCKS)) if k not in (i, j)])
            name = F.to_binary(F.lpad(F.hex(top + F.lit((i * len(BLOCKS) + j) << 32)), 10, "0"), F.lit("hex"))
            entries.append(F.struct(name.alias("piece"), F.lit(depth).alias("depth"), leaf.alias("leaf")))
    return classes.select("fp", F.explode(F.array(*entries)).alias("e")).select(
        "e.piece", "e.depth", F.lit(0).alias("err"), F.lit(0).alias("side"), F.lit(False).alias("crossed"), "e.leaf", "fp")


def _deeper(rows: DataFrame) -> DataFrame:
    """Large pieces cut into the pairs of nodes ``STEP`` bits further down that are within the budget.

    A leaf goes to each pair that its node is part of. Below a node with itself,
    the lesser of two nodes is the first side; below a pair the sides stay.
    """
    down = f"least({STEP}, depth)"
    nodes = rows.selectExpr("*", f"cast(shiftrightunsigned(leaf, depth - {down}) & (shiftleft(1, {down}) - 1) as int) digit").selectExpr(
        "*", f"explode(sequence(0, shiftleft(1, {down}) - 1)) other")
    return (nodes.withColumn("differ", F.expr("cast(err + bit_count(digit ^ other) as int)")).where(F.col("differ") <= BUDGET)
            .withColumn("swap", F.expr("if(crossed, side = 1, digit > other)"))
            .selectExpr(f"concat(piece, to_binary(lpad(hex(if(swap, other, digit) * {1 << STEP} + if(swap, digit, other)), 2, '0'), 'hex')) piece",
                        f"depth - {down} depth", "differ err", "cast(swap as int) side", "crossed OR digit <> other crossed", "leaf", "fp"))


def links(classes: DataFrame, leaf_limit: int = LEAVES) -> DataFrame:
    """(a, b): forests of the links among distinct fingerprints ``fp``."""
    columns = [c.split()[0] for c in _PIECE.split(", ")]
    pieces, found = _subtrees(classes), None
    while True:
        walked = stored(pieces.select(*columns).repartition("piece").sortWithinPartitions("piece", "side", "leaf")
                        .mapInArrow(_walk_pieces(leaf_limit), _WALKED), "simhash-links")
        edges = walked.where("NOT hot").select("a", "b")
        found = edges if found is None else found.union(edges)
        large = walked.where("hot").select(*columns)
        if large.isEmpty():
            return found
        pieces = _deeper(large)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    rows = stored(fingerprints(docs), "simhash-rows")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    linked = components(links(classes)).withColumnsRenamed({"id": "fp"})
    rooted = classes.join(linked, "fp")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    members = rooted.join(least, "root").select("fp", "component")
    named = stored(classes.join(members, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id")), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
