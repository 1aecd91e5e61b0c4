"""The word-end BPE vocabulary file: its pre-tokens, merges and special strings.

Texts are cut at special strings first (as the tokenizer library does by
default), then at white space. Nothing of the file's pattern or normalisation
reaches over white space, so each chunk between white space has one encoding,
whatever its text: callers encode distinct chunks.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex

from .common import SPACE, space_chunks

#: The vocabulary's own pre-token pattern (fixed value; white space spelled out).
PRE_TOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
#: The same for texts of ASCII characters alone.
ASCII_TOKEN = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9]+")
WORD_END = "</w>"
#: Symbols of a word up to which plain merging is faster than a heap.
PLAIN = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


def normalised(text: str) -> str:
    """Composed (NFC) and in lower case letter by letter: a final sigma stays a plain one.

    Neither reaches over white space, so whole texts and their chunks give the same.
    """
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a whole text without special strings, normalised; none reaches over white space."""
    plain = normalised(text)
    return (ASCII_TOKEN if plain.isascii() else PRE_TOKEN).findall(plain)


class WordBpe:
    """Vocabulary and merges. Symbols of a word are byte letters; the last one carries the word end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        v = self.vocab
        #: (left id, right id) -> (rank, merged id)
        self.merges = {(v[a], v[b]): (rank, v[a + b]) for rank, (a, b) in enumerate(pairs) if a in v and b in v}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in v.items()} | {i: s for s, i in self.specials.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self._letters = byte_letters()

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.specials)

    def parts(self, text: str) -> list[str]:
        """Special strings and the texts between them, in order."""
        return self._special.split(text)

    def pieces(self, text: str) -> list[str]:
        """Special strings and the chunks between white space, in order."""
        if not self.has_special(text):
            return space_chunks(text)
        return [c for part in self.parts(text)
                for c in ([part] if part in self.specials else space_chunks(part))]

    def letters(self, word: str) -> str:
        """A normalised pre-token as a string of byte letters."""
        if word.isascii() and word.isprintable():
            return word
        letters = self._letters
        return "".join([letters[b] for b in word.encode("utf-8")])

    def words(self, chunk: str) -> list[str]:
        """Pre-tokens of one chunk, as strings of byte letters.

        Composed (NFC) and in lower case letter by letter: a final sigma stays
        a plain one.
        """
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            return [w.translate(_CONTROL) if not w.isprintable() else w for w in PRE_TOKEN.findall(chunk.lower())]
        plain = normalised(chunk)
        letters = self._letters
        if plain.isalpha():
            return ["".join([letters[b] for b in plain.encode("utf-8")])]
        return ["".join([letters[b] for b in w.encode("utf-8")]) for w in PRE_TOKEN.findall(plain)]

    def symbols(self, word: str) -> list[int]:
        v = self.vocab
        return [v[c] for c in word[:-1]] + [v[word[-1] + WORD_END]]

    def merge(self, ids: list[int]) -> list[int]:
        """The lowest rank first, leftmost on ties: plainly in short words, from a heap of pairs in long ones."""
        ids, merges = list(ids), self.merges
        if len(ids) > PLAIN:
            return self._merge_long(ids)
        while len(ids) > 1:
            best = min(((merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges), default=None)
            if best is None:
                break
            i = best[1]
            ids[i:i + 2] = [merges[ids[i], ids[i + 1]][1]]
        return ids

    def _merge_long(self, ids: list[int | None]) -> list[int]:
        """The same in about n log n steps: places keep their numbers, merged ones are None and skipped."""
        merges, n = self.merges, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            m = merges.get((ids[i], ids[j])) if j < n else None
            if m is None or m[0] != rank:  # the pair is gone; a merged place is None, which no pair has
                continue
            ids[i], ids[j], after[i] = m[1], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                m = merges.get((ids[k], ids[after[k]])) if k >= 0 and after[k] < n else None
                if m:
                    heappush(heap, (m[0], k))
        return [t for t in ids if t is not None]


_CONTROL = {b: c for b, c in enumerate(byte_letters()) if b < 128 and chr(b) != c}


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One vocabulary per Python worker, kept between tasks."""
    return WordBpe(path)
