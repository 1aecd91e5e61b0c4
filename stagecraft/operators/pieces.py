"""Pieces of rules in paths: hashes of a text's windows, and a bitmap of those that rules have.

A piece is a window of a LIKE pattern between two "%": letters, with at most one
run of "_" (``ANY``) within; the pattern's own begin and end count as letters
(``FIRST``, ``LAST``). Its shape says which of its places are letters. A text holds
a piece if one of its windows of that shape has the same letters. Windows are
hashed by sums of powers over a whole batch of texts; letters are code points, as
for LIKE. Equal letters have equal hashes; the reverse is for the caller to check.
"""

from __future__ import annotations

import re
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

#: What stands in a piece for the begin and end of a text and for any one letter. Texts may hold them too.
FIRST, LAST, ANY = "\u0002", "\u0003", "\u0001"
#: Letters hashed at a time (a longer text goes alone).
LIMIT = 1 << 16
#: Bits of the bitmap: 32 a key, 32 MB at most; a fuller one lets more windows through. A key sets three bits of one block.
BITS_A_KEY, LEAST, MOST, BLOCK = 32, 16, 28, 15

_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins (and the last ends)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not raw.size or raw.max() < 128:
        return raw.astype(np.uint64), offsets
    try:
        text = raw.tobytes().decode()
        starts = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])[offsets]
    except UnicodeDecodeError:
        texts = [x.decode(errors="replace") for x in column.to_pylist()]
        text, starts = "".join(texts), np.cumsum([0, *map(len, texts)])
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64), starts.astype(np.int64)


class _Hashes:
    """Hashes of windows; the powers are kept from batch to batch."""

    def __init__(self):
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def read(self, letters: np.ndarray) -> None:
        n = len(letters) + 1
        if n > len(self.powers):
            size = max(n, LIMIT + 1)
            self.powers, self.inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                                         for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(letters * self.powers[:n - 1], out=self.sums[1:])

    def of(self, shape: str, at: np.ndarray | None = None) -> np.ndarray:
        """Of the windows that begin ``at`` (else everywhere)."""
        s, n, total = self.sums, len(self.sums) - len(shape), None
        for run in re.finditer("[^_]+", shape):
            a, b = run.span()
            part = s[b:b + n] - s[a:a + n] if at is None else s[at + b] - s[at + a]
            total = part if total is None else total + part
        h = total * (self.inverse[:n] if at is None else self.inverse[at])
        h += np.uint64(zlib.crc32(shape.encode()) * _BASE & (1 << 64) - 1)
        for shift, factor in zip((30, 27), _MIX):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        return h ^ h >> np.uint64(31)


def _held(h: np.ndarray, bits: np.ndarray, top: int) -> np.ndarray:
    """Which hashes the bitmap lets through."""
    index = np.arange(len(h))
    for place in range(3):
        part = h[index]
        at = (part >> np.uint64(64 - (top - BLOCK)) << np.uint64(BLOCK) | part >> np.uint64(BLOCK * place) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
        index = index[bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
    return index


def _windows(hashes: _Hashes, letters: np.ndarray, starts: np.ndarray, shapes: list[str], bits: np.ndarray, top: int):
    """(text, hash) of windows that the bitmap lets through, each once."""
    owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    hashes.read(letters)
    sizes = np.diff(starts)
    for shape in shapes:
        n = len(shape)
        if n > len(letters):
            continue
        if shape[0] == "^" or shape[-1] == "$":  # one window a text
            owner = np.flatnonzero(sizes == n if shape[0] == "^" and shape[-1] == "$" else sizes >= n)
            h = hashes.of(shape, starts[owner] if shape[0] == "^" else starts[owner + 1] - n)
            kept = _held(h, bits, top)
            owner = owner[kept]
        else:
            h = hashes.of(shape)
            kept = _held(h, bits, top)
            owner = np.searchsorted(starts, kept, "right") - 1
            inside = kept + n <= starts[owner + 1]
            kept, owner = kept[inside], owner[inside]
        owners.append(owner)
        found.append(h[kept])
    owner, h = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return owner[new], h[new]


def with_keys(index: DataFrame) -> DataFrame:
    """``index`` (with piece, shape) and the hash of its piece as ``key``; null without a piece."""
    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            pieces, shapes = batch.column("piece"), batch.column("shape").dictionary_encode()
            letters, starts = _letters(pieces.fill_null(""))
            codes, names = shapes.indices.fill_null(-1).to_numpy(), shapes.dictionary.to_pylist()
            keys = np.zeros(len(pieces), np.uint64)
            hashes.read(letters)
            for i, shape in enumerate(names):
                keys[codes == i] = hashes.of(shape, starts[:-1][codes == i])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64), mask=codes < 0)], names=[*batch.schema.names, "key"])

    return index.mapInArrow(run, index.schema.simpleString().removeprefix("struct<").removesuffix(">") + ",key:bigint")


def bitmap(keys: DataFrame) -> tuple[bytes, int]:
    """The bitmap of ``key`` and its size as a power of two; rows at the driver are its blocks of 4 KB."""
    top = min(max((BITS_A_KEY * max(keys.count(), 1) - 1).bit_length(), LEAST), MOST)
    rows = (keys.select(F.shiftrightunsigned("key", 64 - (top - BLOCK)).alias("block"), "key").repartition("block")
            .select("block", F.explode(F.array(*[F.shiftrightunsigned("key", BLOCK * i).bitwiseAND((1 << BLOCK) - 1) for i in range(3)])).alias("bit"))
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))).toArrow()
    out = np.zeros((1 << top - BLOCK, 1 << BLOCK - 3), np.uint8)
    for block, bits in zip(rows["block"].to_pylist(), rows["bits"]):
        out[block] = np.frombuffer(bits.as_buffer(), np.uint8)
    return out.tobytes(), top


def windows(texts: DataFrame, shapes: list[str], bits, top: int) -> DataFrame:
    """(_id, _piece) of ``texts`` (id, text with FIRST and LAST): their windows of these shapes that the bitmap lets through."""
    def run(batches):
        seen, hashes = np.frombuffer(bits.value, np.uint8), _Hashes()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            letters, starts = _letters(batch.column(1))
            cuts = np.unique(np.append(np.searchsorted(starts[:-1], np.arange(0, len(letters), LIMIT)), len(ids)))
            for a, b in zip(np.append(0, cuts[cuts > 0])[:-1], cuts[cuts > 0]):
                owner, h = _windows(hashes, letters[starts[a]:starts[b]], starts[a:b + 1] - starts[a], shapes, seen, top)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][owner]), pa.array(h.view(np.int64))], names=["_id", "_piece"])

    return texts.mapInArrow(run, "_id long, _piece long")


# Executors need pyarrow and numpy, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
