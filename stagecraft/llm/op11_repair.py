"""Conversation structure repair: the cheapest edits that make roles alternate, by min-plus products over a grammar.

A conversation's rows, by turn, are symbols: role initial and fault (blank and
duplicate rows must go; a truncated row costs more if it stays). Edits (Keep,
Rerole, Delete, Insert) lead through the states of ``(s?(ua)+)?``; a symbol is a
4 x 4 transfer matrix whose cells hold the least cost between two states and the
edits' initials as a rope, ties going to the ASCII-least. Cells of equal cost are
never prefixes of each other (a longer one holds more paid inserts), so the lesser
rope stays the lesser in every product and the product is associative.

A task takes the symbol sequences of many conversations at once, each different
one once, and builds a Re-Pair grammar: the commonest neighbours become a rule
until none repeats. Each rule's matrix is one product of its parts' matrices,
bottom-up, shared by all conversations of the slice.

Conversations of any length are spread: rows are range-partitioned and sorted by
conversation, turn, role and text. A conversation within one partition is
finished there; one that reaches a partition's edge, or that is large, leaves
pieces (a matrix and counts for each), which are folded in order. Only the digest
of such a conversation's repaired text is made in one task, row by row: SHA-256
has no parts that could be joined.

``damage`` makes the faulty input that the registered query repairs; ``repair``
takes any table of conversations.

Odd input: nulls in conversation, role and text are one space where they are
compared, hashed or written, but a null conversation stays null in the result;
rows of one turn are in the order of role, then text; null turns come first. A
role of other initials than s, u and a (an empty one too) cannot be kept.
``gaps`` is null beyond a long's range. Other columns are not read. A table
without rows gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import arrow_schema, give_back, stored

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: White space that a blank row consists of.
BLANK = " \t\n\x0b\x0c\r"
#: Rows and bytes of text after which a conversation's rows so far become a piece, or a slice is evaluated.
PIECE_ROWS, PIECE_BYTES = 1 << 14, 8 << 20
#: Characters up to which ropes are plain strings, and symbols up to which a conversation is a chain of vectors.
FLAT, CHAIN = 32, 64

# -- states: 0 nothing yet, 1 after s, 2 after u, 3 after a; a conversation may end in 0 and 3
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)
#: Inserts between states (only the fewest matter).
_INSERTS = {(0, 0): 0, (0, 2): 1, (0, 3): 2, (1, 1): 0, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 3): 0, (3, 2): 1}
#: A row that must go; others are 1 + 2 * role + truncated.
GONE = 0
_ROLES = "sua-"


# -- ropes: strings, or (length, left, right)

def rope_length(a) -> int:
    return len(a) if isinstance(a, str) else a[0]


def rope_join(a, b):
    n = rope_length(a) + rope_length(b)
    if n <= FLAT:
        return rope_text(a) + rope_text(b)
    return b if a == "" else a if b == "" else (n, a, b)


def rope_leaves(a) -> Iterator[str]:
    stack = [a]
    while stack:
        a = stack.pop()
        while not isinstance(a, str):
            stack.append(a[2])
            a = a[1]
        yield a


def rope_text(a) -> str:
    return a if isinstance(a, str) else "".join(rope_leaves(a))


def rope_less(a, b) -> bool:
    """Whether ``a`` comes before ``b``; shared beginnings are skipped as wholes."""
    while a is not b and not isinstance(a, str) and not isinstance(b, str) and a[1] is b[1]:
        a, b = a[2], b[2]
    if a is b:
        return False
    left, right = rope_leaves(a), rope_leaves(b)
    x = y = ""
    while True:
        x, y = x or next(left, ""), y or next(right, "")
        if not x or not y:
            return bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


# -- min-plus: matrices are dicts (from, to) -> (cost, rope); a vector is a matrix of one row

def _better(new: tuple, old: tuple | None) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and rope_less(new[1], old[1])


def times(left: dict, right: dict) -> dict:
    by_from: dict = {}
    for (p, q), cell in right.items():
        by_from.setdefault(p, []).append((q, cell))
    out: dict = {}
    for (p, middle), (cost, rope) in left.items():
        for q, (more, rest) in by_from.get(middle, ()):
            old = out.get((p, q))
            if old is None or cost + more <= old[0]:
                new = (cost + more, rope_join(rope, rest))
                if _better(new, old):
                    out[p, q] = new
    return out


def _symbol_matrix(symbol: int) -> dict:
    """Inserts, then one edit of the row."""
    edits: dict = {}

    def offer(p, q, cost, letter):
        if _better((cost, letter), edits.get((p, q))):
            edits[p, q] = (cost, letter)
    for p in range(4):
        offer(p, p, DELETE, "D")
        if symbol != GONE:
            role, cut = _ROLES[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)
            if (p, role) in _NEXT:
                offer(p, _NEXT[p, role], cut, "K")
            for to in "ua":
                if (p, to) in _NEXT:
                    offer(p, _NEXT[p, to], cut + REROLE, "R")
    return times({at: (INSERT * n, "I" * n) for at, n in _INSERTS.items()}, edits)


SYMBOLS = 1 + 2 * len(_ROLES)
_MATRICES = [_symbol_matrix(s) for s in range(SYMBOLS)]
_LAST_INSERTS = {at: (INSERT * n, "I" * n) for at, n in _INSERTS.items()}
_START = {(0, 0): (0, "")}


def finish(vector: dict) -> tuple[int, str]:
    """Cost and audit of the cheapest end."""
    best = None
    ends = times(vector, _LAST_INSERTS)
    for state in _ENDS:
        if (0, state) in ends and _better(ends[0, state], best):
            best = ends[0, state]
    return best[0], rope_text(best[1])


# -- the grammar

def re_pair(sequences: list[bytes]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sequences over rules: the commonest pair of neighbours becomes a rule until none is found twice."""
    parts = []
    for s in sequences:
        parts += [np.frombuffer(s, np.uint8).astype(np.int64), np.array([-1])]
    flat, rules = np.concatenate(parts) if parts else np.zeros(0, np.int64), []
    while len(flat) > 1:
        at = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
        if not len(at):
            break
        codes = (flat[at] << 32) | flat[at + 1]
        values, numbers = np.unique(codes, return_counts=True)
        best = int(values[np.argmax(numbers)])
        left, right = best >> 32, best & 0xFFFFFFFF
        at = at[codes == best]
        if left == right:  # of overlapping places every second one is taken
            fresh = np.concatenate([[True], np.diff(at) != 1])
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
        if numbers.max() < 2 or len(at) < 2:
            break
        flat[at] = SYMBOLS + len(rules)
        flat = np.delete(flat, at + 1)
        rules.append((left, right))
    ends = np.flatnonzero(flat < 0)
    return [flat[b:e] for b, e in zip(np.concatenate([[0], ends[:-1] + 1]) if len(ends) else [], ends)], rules


def matrices_of(rules: list[tuple[int, int]]) -> list[dict]:
    """One matrix a symbol and rule, each from its parts' matrices."""
    out = list(_MATRICES)
    for left, right in rules:
        out.append(times(out[left], out[right]))
    return out


def product(symbols: list[int], matrices: list[dict]) -> dict:
    """The product of a sequence as a balanced tree."""
    level = [matrices[s] for s in symbols] or [{(p, p): (0, "") for p in range(4)}]
    while len(level) > 1:
        level = [times(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def evaluate(wholes: list[bytes], pieces: list[bytes]) -> tuple[list[tuple[int, str]], list[dict]]:
    """(cost, audit) of whole sequences and matrices of pieces, over one grammar of all of them."""
    distinct = list(dict.fromkeys([*wholes, *pieces]))
    compressed, rules = re_pair(distinct)
    matrices, index = matrices_of(rules), {s: i for i, s in enumerate(distinct)}
    done: dict[bytes, tuple[int, str]] = {}
    for s in dict.fromkeys(wholes):
        symbols = compressed[index[s]].tolist()
        vector = _START
        if len(symbols) <= CHAIN:
            for symbol in symbols:
                vector = times(vector, matrices[symbol])
        else:
            vector = times(vector, product(symbols, matrices))
        done[s] = finish(vector)
    return [done[s] for s in wholes], [product(compressed[index[s]].tolist(), matrices) for s in pieces]


def replay(audit: str, rows: Iterator[tuple[bytes, bytes]]) -> Iterator[tuple[bytes, bytes]]:
    """The repaired rows: ``audit`` tells the edits, the state tells which role an inserted or changed row has."""
    state = 0
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        to = "a" if state == 2 else "u"
        name = b"assistant" if to == "a" else b"user"
        if edit == "I":
            yield name, b""
        else:
            role, text = next(rows)
            if edit == "K":
                to, name = role[:1].decode(), role
            yield name, text
        state = _NEXT[state, to]


# -- rows

def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the remainder of a checksum of conversation and turn: dropped, emptied,
    without sentence ends, doubled, or given to the user. ``copies`` counts a row's occurrences (0: dropped)."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    text, role = _or_space("text"), _or_space("role")
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _or_space(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows as they are compared, with their own faults."""
    copies = F.col("copies").cast("int") if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                _or_space("role").alias("role"), _or_space("text").alias("text"), copies.alias("copies"))
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    cut = ~(F.endswith(end, F.lit(".")) | F.endswith(end, F.lit("!")) | F.endswith(end, F.lit("?")))
    return rows.withColumn("blank", end == "").withColumn("cut", cut)


def _with_later(rows: DataFrame) -> DataFrame:
    """Adds ``later``: the conversation has the same role and text at an earlier turn.

    Only texts that a conversation has at several turns are joined back, and
    they are counted on digests, so no text is shuffled for it.
    """
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    marked = rows.withColumn("digest", digest)
    again = stored(
        marked.where("copies > 0 AND NOT blank").groupBy("conv_id", "digest")
        .agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.max(F.col("turn").isNull()).alias("unnumbered"))
        .where("least <> most OR unnumbered AND most IS NOT NULL")
        .selectExpr("conv_id AS again_conv", "digest AS again_digest", "if(unnumbered, null, least) AS first_turn"), "repair-again")
    joined = marked.join(again, marked["conv_id"].eqNullSafe(again["again_conv"]) & (marked["digest"] == again["again_digest"]), "left")
    return joined.withColumn("later", F.col("again_digest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))).select(*rows.columns, "later")


_COUNTS = "gap_least long, gap_most long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long"
_PIECE = f"conv_id long, whole boolean, task int, piece int, {_COUNTS}, first_initial string, last_initial string, costs array<long>, audits array<string>, repaired_sha256 string"
_LEGAL = {"su", "ua", "au"}


class _Open:
    """The rows of one conversation so far."""

    __slots__ = ("key", "symbols", "rows", "size", "piece", "least", "most", "turns", "first_turn", "last_turn",
                 "blank", "duplicate", "truncated", "illegal", "first", "last", "before", "edge")

    def __init__(self, key, edge: bool):
        self.key, self.edge, self.piece, self.before = key, edge, 0, None
        self.clear()

    def clear(self):
        self.symbols, self.rows, self.size = bytearray(), [], 0
        self.least = self.most = self.first_turn = self.last_turn = self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: bytes, text: bytes, copies: int, blank: bool, cut: bool, later: bool):
        initial = role.decode()[:1]
        for _ in range(copies):
            same = later or (turn, role, text) == self.before
            if blank:
                self.blank += 1
            elif same:
                self.duplicate += 1
            elif cut:
                self.truncated += 1
            self.symbols.append(GONE if blank or same else 1 + 2 * (_ROLES.find(initial) if initial in ("s", "u", "a") else 3) + cut)
            self.rows.append((role, text))
            self.size += len(text)
            if self.last is not None and self.last + initial not in _LEGAL:
                self.illegal += 1
            self.first, self.last = initial if self.first is None else self.first, initial
            self.before = (turn, role, text)
        if copies and turn is not None:
            self.least, self.most = (turn if self.least is None else self.least), turn
            if self.last_turn != turn:
                self.turns += 1
            self.first_turn, self.last_turn = (turn if self.first_turn is None else self.first_turn), turn

    def counts(self) -> list:
        return [self.least, self.most, self.turns, self.first_turn, self.last_turn, self.blank, self.duplicate, self.truncated, self.illegal]


def _digest(rows: Iterator[tuple[bytes, bytes]]) -> str:
    out = hashlib.sha256()
    for i, (role, text) in enumerate(rows):
        out.update((b"\n" if i else b"") + role + b":" + text)
    return out.hexdigest()


def _small_slices(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``PIECE_BYTES`` of text, or one row."""
    ends = np.cumsum([n or 0 for n in pc.binary_length(batch.column(text_at)).to_pylist()])
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + PIECE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _columns(batch: pa.RecordBatch, *binary: int) -> list[list]:
    return [(c.cast(pa.binary()) if i in binary else c).to_pylist() for i, c in enumerate(batch.columns)]


def _repair_sorted(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished conversations and pieces of a partition sorted by conversation, turn, role and text."""
    task = TaskContext.get().partitionId()
    wholes: list[_Open] = []
    pieces: list[tuple] = []
    now: _Open | None = None
    held = [0, 0]

    def close(piece: bool):
        if piece:  # its counts and symbols; the rows are read again when the audit is known
            pieces.append((now.key, now.piece, now.counts(), now.first, now.last, bytes(now.symbols)))
            held[0] += len(now.symbols)
            now.piece += 1
            now.clear()
        else:
            wholes.append(now)
            held[0], held[1] = held[0] + len(now.symbols), held[1] + now.size

    def results() -> pa.RecordBatch:
        done, products = evaluate([bytes(w.symbols) for w in wholes], [p[5] for p in pieces])
        out = [(w.key, True, task, 0, *w.counts(), w.first, w.last, [cost], [audit], _digest(replay(audit, iter(w.rows))))
               for w, (cost, audit) in zip(wholes, done)]
        for (key, number, counts, first, last, _), cells in zip(pieces, products):
            grid = [cells.get((p, q)) for p in range(4) for q in range(4)]
            out.append((key, False, task, number, *counts, first, last, [c and c[0] for c in grid], [c and rope_text(c[1]) for c in grid], None))
        wholes.clear()
        pieces.clear()
        held[:] = 0, 0
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    try:
        for batch in batches:
            for part in _small_slices(batch, 3):
                for key, turn, role, text, copies, blank, cut, later in zip(*_columns(part, 2, 3)):
                    if now is None or key != now.key:
                        if now is not None:
                            close(now.edge or now.piece > 0)
                        now = _Open(key, now is None)
                        if held[0] >= PIECE_ROWS or held[1] >= PIECE_BYTES:
                            yield results()
                    now.add(turn, role, text, copies, blank, cut, later)
                    if len(now.symbols) >= PIECE_ROWS or now.size >= PIECE_BYTES:
                        close(True)
                        yield results()
        if now is not None:
            close(True)
        if wholes or pieces:
            yield results()
    finally:
        give_back()


_FOLDED = f"conv_id long, {_COUNTS}, cost long, audit string"


def _fold_sorted(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its pieces in order; a piece at a time is held, and four ropes."""
    state, names = None, [c.split()[0] for c in _COUNTS.split(", ")]

    def row(state) -> pa.RecordBatch:
        key, c, _, vector = state
        values = (key, *(c[n] for n in names), *finish(vector))
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema)

    for batch in batches:
        for i in range(batch.num_rows):
            r = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}
            cells = {(k // 4, k % 4): (cost, audit) for k, (cost, audit) in enumerate(zip(r["costs"], r["audits"])) if cost is not None}
            if state is not None and state[0] == r["conv_id"]:
                _, c, last, vector = state
                if last is not None and r["first_initial"] is not None and last + r["first_initial"] not in _LEGAL:
                    c["illegal"] += 1
                if r["turns"] and c["turns"] and r["first_turn"] == c["last_turn"]:
                    c["turns"] -= 1
                for n in ("turns", "blank", "duplicate", "truncated", "illegal"):
                    c[n] += r[n]
                for n in ("gap_least", "first_turn"):
                    c[n] = r[n] if c[n] is None else c[n]
                for n in ("gap_most", "last_turn"):
                    c[n] = c[n] if r[n] is None else r[n]
                state = (r["conv_id"], c, last if r["last_initial"] is None else r["last_initial"], times(vector, cells))
            else:
                if state is not None:
                    yield row(state)
                state = (r["conv_id"], {n: r[n] for n in names}, r["last_initial"], times(_START, cells))
    if state is not None:
        yield row(state)


def _replayed(rows: DataFrame, audits: DataFrame, schema: str, emit) -> DataFrame:
    """``emit(conv_id, repaired rows)`` for every conversation of ``audits``, read in order; its audit comes first."""
    known = audits.select(F.col("conv_id").alias("known"))
    mine = rows.where("copies > 0").join(known, rows["conv_id"].eqNullSafe(known["known"]), "left_semi")
    stream = mine.selectExpr("conv_id", "1 AS kind", "turn", "role", "text", "copies").union(
        audits.selectExpr("conv_id", "0 AS kind", "cast(null AS long)", "''", "audit", "1"))

    def run(batches):
        def lines():
            for batch in batches:
                for part in _small_slices(batch, 4):
                    yield from zip(*_columns(part, 3, 4))
        source = lines()
        head = next(source, None)
        while head is not None:
            key, audit = head[0], head[4].decode()
            following = []

            def rows_of():
                for line in source:
                    if line[1] == 0:
                        following.append(line)
                        return
                    for _ in range(line[5]):
                        yield line[3], line[4]
            mine = rows_of()
            yield from emit(key, replay(audit, mine))
            for _ in mine:  # nothing is left: the audit covers every row
                raise RuntimeError("an audit that ends before its conversation")
            head = following[0] if following else None

    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text").mapInArrow(run, schema)


def _emit_digest(key, rows):
    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([_digest(rows)])], names=["key", "repaired_sha256"])


def _emit_rows(key, rows):
    number, done = count(), False
    while not done:
        part, size = [], 0
        for role, text in rows:
            part.append((key, next(number), role.decode(), text.decode()))
            size += len(text)
            if size >= PIECE_BYTES or len(part) >= PIECE_ROWS:
                break
        else:
            done = True
        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=["conv_id", "turn", "role", "text"])


def repair(conversations: DataFrame) -> DataFrame:
    """A row a conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    A ``copies`` column, where there is one, tells how often a row stands in a
    row; 0 names a conversation without giving it a row.
    """
    rows = _rows(conversations)
    dealt = (_with_later(rows).select("conv_id", "turn", "role", "text", "copies", "blank", "cut", "later")
             .repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
             .sortWithinPartitions("conv_id", "turn", "role", "text"))
    parts = stored(dealt.mapInArrow(partial(_repair_sorted, arrow_schema(_PIECE)), _PIECE), "repair-parts")
    counts = [c.split()[0] for c in _COUNTS.split(", ")]
    folded = stored(parts.where("NOT whole").drop("whole", "repaired_sha256").repartition("conv_id")
                    .sortWithinPartitions("conv_id", "task", "piece").mapInArrow(partial(_fold_sorted, arrow_schema(_FOLDED)), _FOLDED), "repair-folded")
    digests = _replayed(rows, folded.select("conv_id", "audit"), "key long, repaired_sha256 string", _emit_digest)
    large = folded.join(digests, folded["conv_id"].eqNullSafe(digests["key"])).select("conv_id", *counts, "cost", "audit", "repaired_sha256")
    small = parts.where("whole").select("conv_id", *counts, F.element_at("costs", 1).alias("cost"), F.element_at("audits", 1).alias("audit"), "repaired_sha256")
    # Beyond a long's range only for turns at both ends of it.
    gaps = F.expr("coalesce(try_subtract(try_add(try_subtract(gap_most, gap_least), 1L), turns), if(gap_least IS NULL, 0L, null))")
    return small.union(large).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired_rows(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """The repaired conversations as rows ``conv_id, turn, role, text``, turns numbered from 0; inserted texts are empty."""
    return _replayed(_rows(conversations), repaired.select("conv_id", "audit"), "conv_id long, turn long, role string, text string", _emit_rows)
