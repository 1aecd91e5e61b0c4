"""Operator 10: benchmark decontamination by template canonicalisation.

Texts are cut at white space; edges of punctuation go, letters become lower
case. Three kinds of words become typed placeholders: numbers (a word with a
digit), units right after a number, and names (a capitalised word inside a
sentence). Windows of ``WINDOW`` such words are hashed. A re-parameterised
question keeps its template, so its windows meet the benchmark's.

A bitmap of fixed size (1 MB) of the benchmark's window hashes goes to all
tasks; windows that it rules out are never shuffled. What is left is joined
with the benchmark's windows on the whole hash, which stays exact however
large the benchmark is (a full bitmap only filters less). Benchmark items with
one template share one row.

A value may have another number of words in a copy ("Tom" and "Mary Ann",
"5000" and "5 000"): runs of up to ``MERGED`` names or numbers without
punctuation between them are also read as one placeholder, and windows with
such a run are hashed beside those of single words.

Matching windows of a text and an item are chained in the order of both; from
one to the next the distance of text and item may change by ``DRIFT`` words, so
words put in, left out or replaced do not end a copy (``chains``). The longest
chains and the windows at each exact distance are candidates. The slots (the
words behind the placeholders) must be consistent: each value of the item, with
its kind, has one value in the copy, in ``SLOTS`` of the places at least; two
values of the item may become one (3 and 5: 4 and 4). One exception is let pass
from seven slots on; in fewer it makes another question. A text is contaminated by an
item if a consistent candidate holds ``SHARE`` of the item's windows, or covers
``WORDS`` of its words, or if ``RUN`` words of it lie in the text in a row with
consistent slots, however long the item is. A copy without ``WINDOW`` unchanged
words in a row is not found.

Cases: null or empty texts and items, and items of fewer than ``WINDOW``
words, have no windows and match nothing. ``leaks`` reports by id: repeated ids
are one text there, and rows without id have no row. ``clean`` judges each row
by its id and text, rows without id too. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import give_back, id_and_text, stored, text_slices
from .op5_quality_rules import window_hash

WINDOW, SHARE, WORDS, RUN, DRIFT, MERGED = 8, 0.5, 0.7, 20, 8, 4
SLOTS = 0.85
FILTER_BITS = 23
#: Bytes of text of a slice: a step holds about 30 times as much.
SLICE = 2 << 20
#: Unit names (fixed values).
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t oz lb ml l s sec min h hr hours minutes seconds days weeks months years "
                  "meters metres kilometers kilometres miles feet inches grams kilograms pounds liters litres dollars euros percent".split())
NUMBER, UNIT, NAME = 1, 2, 3  # codes of the placeholders
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


class _Chunks:
    """Distinct chunks of a slice: their number, code, kind and role in a sentence."""

    def __init__(self):
        self.numbers: dict[str, int] = {}

    def add(self, text: str) -> np.ndarray:
        numbers = self.numbers
        return np.array([numbers.setdefault(c, len(numbers)) for c in text.split()], np.int64)

    def tables(self):
        """Per chunk: code of the word, whether a number, unit, or capitalised, whether it ends a sentence, and whether punctuation follows."""
        n = len(self.numbers)
        code, number, unit, capital, end, stop = np.zeros(n, np.uint64), *(np.zeros(n, bool) for _ in range(5))
        for c, i in self.numbers.items():
            word = c if c.isalpha() else _EDGE.sub("", c)
            code[i] = (hash_text(word.lower()) << 2) & ((1 << 64) - 1) | 4
            if not word.isalpha():
                number[i] = any(x.isdigit() for x in word)
            end[i] = c.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":")
            stop[i] = not c[-1].isalnum()
            capital[i] = word[:1].isupper()
            unit[i] = word.lower() in UNITS
        return code, number, unit, capital, end, stop


def hash_text(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def templates(texts: list[str]):
    """Codes of all words, the text of each, the words by number, the number at each place, and whether a run goes on there."""
    chunks = _Chunks()
    found = [chunks.add(t) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    code, number, unit, capital, end, stop = chunks.tables()
    names = list(chunks.numbers)
    if not len(at):
        return np.zeros(0, np.uint64), doc, names, at, np.zeros(0, bool)
    before = np.concatenate([[True], doc[1:] != doc[:-1]])  # first word of a text
    after_end = np.concatenate([[True], end[at][:-1]]) | before
    after_number = np.concatenate([[False], number[at][:-1]]) & ~before
    out = code[at]
    out = np.where(capital[at] & ~after_end, np.uint64(NAME), out)
    out = np.where(unit[at] & after_number, np.uint64(UNIT), out)
    out = np.where(number[at], np.uint64(NUMBER), out)
    goes_on = np.concatenate([[False], (out[1:] == out[:-1]) & ((out[1:] == NUMBER) | (out[1:] == NAME)) & ~stop[at][:-1]]) & ~before
    return out, doc, names, at, goes_on


def merged(goes_on: np.ndarray) -> np.ndarray:
    """Places of the words that begin a word, or a run of up to ``MERGED`` words read as one."""
    first = np.flatnonzero(~goes_on)
    length = np.diff(np.append(first, len(goes_on)))
    return np.flatnonzero(~goes_on | np.repeat(length > MERGED, length))


def windows(texts: list[str], keep=None):
    """(text, place, hash, slots, span) of the windows that ``keep`` does not rule out; ``span`` is in words.

    A slot is its place in the window (two digits), its kind (a digit) and its words.
    """
    code, doc, names, at, goes_on = templates(texts)
    first = np.searchsorted(doc, np.arange(len(texts)))
    places, hashes, slots, spans = [], [], [], []
    heads = merged(goes_on)
    # Once with all words, once with runs as one word: there, only windows with a run are new.
    for heads, plain in ((np.arange(len(code)), True), (heads, False)):
        if len(heads) < WINDOW or not plain and len(heads) == len(code):
            continue
        ends = np.append(heads[1:], len(code))
        starts = np.arange(len(heads) - WINDOW + 1)
        inside = doc[heads[:len(starts)]] == doc[heads[WINDOW - 1:]]
        span = ends[WINDOW - 1:] - heads[:len(starts)]
        starts = starts[inside & (plain | (span > WINDOW))]
        h = window_hash(code[heads], WINDOW)[starts]
        if keep is not None:
            some = keep(h)
            starts, h = starts[some], h[some]
        for s in starts.tolist():
            begin = int(heads[s])
            slots.append([f"{heads[k] - begin:02d}{code[heads[k]]}" + " ".join(_EDGE.sub("", names[at[w]]) for w in range(heads[k], ends[k]))
                          for k in range(s, s + WINDOW) if code[heads[k]] in (NUMBER, UNIT, NAME)])
        places.append(heads[starts])
        hashes.append(h)
        spans.append(span[starts])
    place, h, span = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, hashes, spans))
    return doc[place], place - first[doc[place]], h.view(np.int64), slots, span


_WINDOWS = "id long, place int, hash long, slots array<string>, span int, n_words int"


def window_rows(texts: DataFrame, bits: bytes | None = None) -> DataFrame:
    """Windows of ``texts`` (id, text); with ``bits``, those that the bitmap lets through."""
    def run(batches):
        bitmap = np.frombuffer(bits, np.uint8) if bits is not None else None

        def keep(h):
            at = h >> np.uint64(64 - FILTER_BITS)
            return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

        def rows(ids, slice_):  # a function of its own: its arrays are gone before the next slice
            doc, place, h, slots, span = windows(slice_, keep if bits is not None else None)
            words = np.array([len(t.split()) for t in slice_]) if bits is None else np.zeros(len(slice_), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([i if i is not None else -1 for i in ids], np.int64)[doc], mask=np.array([i is None for i in ids], bool)[doc]),
                 pa.array(place, type=pa.int32()), pa.array(h), pa.array(slots, type=pa.list_(pa.string())), pa.array(span, type=pa.int32()), pa.array(words[doc], type=pa.int32())],
                names=["id", "place", "hash", "slots", "span", "n_words"])

        try:
            for part in text_slices(batches, SLICE):
                yield rows(*part)
        finally:
            give_back()

    return texts.mapInArrow(run, _WINDOWS)


def bitmap(bench: DataFrame) -> bytes:
    """The benchmark's hashes as a bitmap of 2 ** FILTER_BITS bits, set in words of 64 bits: 2 MB of rows at the driver at most.

    One job, however many partitions the words are in.
    """
    words = (bench.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("bits"))).toArrow()
    out = np.zeros(1 << FILTER_BITS - 6, "<i8")
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.tobytes()


def chains(matches: list[tuple[int, int]]) -> list[list[int]]:
    """Candidates among matching windows (place, item_place), sorted: lists of their numbers.

    The windows of each exact distance, and the longest chains: both places
    rise, and the distance changes by ``DRIFT`` at most from one to the next.
    """
    best, link = [1] * len(matches), [-1] * len(matches)
    lines: dict[int, list[int]] = {}  # matches of one distance; the last one before a place ends the longest chain there
    at: dict[int, list[int]] = {}
    for i, (place, item) in enumerate(matches):
        shift = place - item
        for other in range(shift - DRIFT, shift + DRIFT + 1):
            if other in at and (n := bisect_left(at[other], min(place, item + other))):
                j = lines[other][n - 1]
                if best[j] >= best[i]:
                    best[i], link[i] = best[j] + 1, j
        lines.setdefault(shift, []).append(i)
        at.setdefault(shift, []).append(place)
    found, used = list(lines.values()), [False] * len(matches)
    for i in sorted(range(len(matches)), key=lambda i: -best[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = link[i]
        if len(chain) > 1:
            found.append(chain[::-1])
    return found


def consistent(slots: dict) -> bool:
    """Whether each item's kind and value has one value in the copy, in ``SLOTS`` of all places at least.

    ``slots``: (place, item's kind and value) -> (place, copy's kind and value).
    """
    pairs = Counter((theirs, ours) for (_, theirs), (_, ours) in slots.items())
    most: dict[str, int] = {}
    for (theirs, _), n in pairs.items():
        most[theirs] = max(most.get(theirs, 0), n)
    return sum(most.values()) >= SLOTS * len(slots)


def longest_run(chain: list[dict]) -> int:
    """Most words in a row, at one distance, whose slots have one value for each value of the item."""
    longest, begin, end, seen, shift, last = 0, 0, -1, -1, None, {}
    for m in chain:
        if m["span"] != m["item_span"]:
            continue
        if m["place"] - m["item_place"] != shift or m["item_place"] > end:
            shift, begin, last, seen = m["place"] - m["item_place"], m["item_place"], {}, -1
        new = [(place, theirs, ours) for (place, theirs), (_, ours) in slots_of(m) if place > seen]
        for place, theirs, ours in new:
            value, before = last.get(theirs, (ours, place))
            if value != ours:
                longest = max(longest, place - begin)
                begin = max(begin, before + 1)
            last[theirs] = ours, place
            seen = place
        end = m["item_place"] + m["item_span"]
        longest = max(longest, end - begin)
    return longest


def slots_of(m: dict) -> list:
    """((place, item's kind and value), (place, copy's kind and value)) of a match's slots."""
    return [((m["item_place"] + int(a[:2]), a[2:]), (m["place"] + int(b[:2]), b[2:])) for a, b in zip(m["item_slots"], m["slots"])]


_FOUND = "doc_id long, item_id long, n_windows int, share double, n_slots int, first_word int, n_words int"


def best_copy(table: pa.Table) -> pa.Table:
    """The best copy among the matches of one text and item, if any counts."""
    by_place: dict = {}
    for m in table.to_pylist():
        key = m["place"], m["item_place"]
        if key not in by_place or by_place[key]["item_span"] < m["item_span"]:
            by_place[key] = m
    order = sorted(by_place)
    top = None
    for chain in chains(order):
        rows = [by_place[order[i]] for i in chain]
        covered = len({w for m in rows for w in range(m["item_place"], m["item_place"] + m["item_span"])})
        slots = dict(x for m in rows for x in slots_of(m))
        m = rows[0]
        whole = len(rows) >= SHARE * (m["item_words"] - WINDOW + 1) or covered >= WORDS * m["item_words"]
        if whole and consistent(slots) or covered >= RUN and longest_run(rows) >= RUN:
            copy = (len(rows), covered / m["item_words"], len({(a[1], b[1]) for a, b in slots.items()}), m["place"],
                    max(r["place"] + r["span"] for r in rows) - m["place"])
            top = max(top or copy, copy)
    names = ["doc_id", "item_id", "n_windows", "share", "n_slots", "first_word", "n_words"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
    values = (table["doc_id"][0].as_py(), table["item_id"][0].as_py(), *top) if top else None
    return pa.table([pa.array([v for v in values[i:i + 1]] if values else [], type=t) for i, t in enumerate(types)], names=names)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a contaminated text and item: doc_id, item_id, n_windows, share (of the item's words), n_slots, first_word, n_words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), "text").where("item_id IS NOT NULL")
    bench = window_rows(id_and_text(items)).withColumnRenamed("id", "item_id")
    # Items with one template (and one set of slots) are one class, named by its least id.
    sign = bench.groupBy("item_id").agg(F.expr("xxhash64(sort_array(collect_list(struct(place, hash, slots, n_words))))").alias("sign"))
    classes = sign.groupBy("sign").agg(F.min("item_id").alias("item_id"))
    bench = stored(bench.join(classes.select("item_id"), "item_id"), "leak-items")
    found = window_rows(id_and_text(docs.where("doc_id IS NOT NULL")), bitmap(bench))
    pairs = (found.select(F.col("id").alias("doc_id"), "place", "hash", "slots", "span").dropDuplicates(["doc_id", "place", "hash"])
             .join(bench.select("item_id", F.col("n_words").alias("item_words"), F.col("place").alias("item_place"), "hash",
                                F.col("slots").alias("item_slots"), F.col("span").alias("item_span")), "hash")
             .where(F.size("slots") == F.size("item_slots")).drop("hash"))
    best = pairs.groupBy("doc_id", "item_id").applyInArrow(best_copy, _FOUND).withColumnRenamed("item_id", "rep")
    members = sign.join(classes.select("sign", F.col("item_id").alias("rep")), "sign").select("rep", F.col("item_id").alias("member"))
    return best.join(members, "rep").select("doc_id", F.col("member").alias("item_id"), "n_windows", "share", "n_slots", "first_word", "n_words")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit(""))))
    gone = leaks(keyed.select(F.col("_key").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(gone, "_key", "left_anti").select(*docs.columns)
