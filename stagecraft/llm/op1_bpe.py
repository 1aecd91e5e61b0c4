"""Operator 1: BPE encoding and decoding by a prefix-sharing trie.

The distinct words of a slice are put in order, which is the depth-first order
of their trie: two neighbours share the path of their common prefix. On that
path each node holds one state, the last token of its prefix's encoding. Of
any encoding, every prefix that ends at a token border is an encoding too, so
the state of a node follows from the states above it: its last token is the
one suffix that is a token whose neighbour on the left, the last token of what
remains, could not have merged with it. Encodings of shared prefixes are so
computed once. A word's last symbol carries the word end, which is an edge of
its own.

The work is map-only: a text needs nothing from other texts, the vocabulary
file has a fixed size, and no row is shuffled. Words already seen by the task
come from a cache of bounded size.

Cases: a null or empty text has no tokens and decodes to ''. Repeated rows
and ties of ``doc_id`` each give their own row. Other columns are not read.
Letters added to Unicode after the installed tables are cut by those tables.
"""

from __future__ import annotations

import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import per_text
from .word_bpe import WORD_END, WordBpe, load, pre_tokens

#: Words (about 200 bytes each) and pairs of tokens (about 110 each) that a task keeps, and bytes of a slice.
CACHE_WORDS = 160_000
CACHE_PAIRS = 150_000
SLICE = 1 << 20
PAIR_BITS = 32
#: Letters of a word up to which a state may wait for those before it.
DEEP = 64


def sizes_by_ending(tokens: dict[str, int]) -> dict[str, tuple[int, ...]]:
    """Lengths of the tokens that may end a prefix, longest first, by the prefix's last letters (3 at most)."""
    found: dict[str, set[int]] = {}
    for t in tokens:
        found.setdefault(t[-3:], set()).add(len(t))
    for ending, sizes in found.items():
        sizes.update(n for n in range(1, len(ending)) if ending[-n:] in tokens)
    return {e: tuple(sorted(s | {1}, reverse=True)) for e, s in found.items()}


class TrieEncoder:
    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        #: Tokens inside a word and at its end, by their letters.
        self.inner = {t: i for t, i in bpe.vocab.items() if not t.endswith(WORD_END)}
        self.final = {t.removesuffix(WORD_END): i for t, i in bpe.vocab.items() if t.endswith(WORD_END)}
        self.inner_sizes, self.final_sizes = sizes_by_ending(self.inner), sizes_by_ending(self.final)
        #: Rank of each merge by its left, then its right token.
        self.ranks: dict[int, dict[int, int]] = {}
        for (left, right), (rank, _) in bpe.merges.items():
            self.ranks.setdefault(left, {})[right] = rank
        self.made_from = {new: (rank, left, right) for (left, right), (rank, new) in bpe.merges.items()}
        #: Caches: whether two tokens (left << PAIR_BITS | right) stay apart, and the ids of words
        #: (those of the last ``CACHE_WORDS`` or fewer words, and the generation before).
        self.pairs: dict[int, bool] = {}
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.strings = pa.array([bpe.strings.get(i, "") for i in range(max(bpe.strings) + 1)])

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens at one edge of ``token`` while it is being built, with the rank at which each is used up."""
        out, used = [(token, float("inf"))], float("inf")
        while token in self.made_from:
            used, token = self.made_from[token][0], self.made_from[token][side]
            out.append((token, used))
        return out

    def stay_apart(self, left: int, right: int) -> bool:
        """True if merging the symbols of both tokens gives just these two.

        They merge across the border if some pair there has a rank below the
        ranks that use up its two sides; on equal ranks the leftmost goes first.
        """
        known, starts = True, self._edge(right, 1)
        for x, x_used in self._edge(left, 2):
            ranks = self.ranks.get(x)
            if ranks and any(y in ranks and ranks[y] < x_used and ranks[y] <= y_used for y, y_used in starts):
                known = False
                break
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left << PAIR_BITS | right] = known
        return known

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Encodings of distinct words (strings of byte letters), depth first over their trie.

        A node's state is found when a longer prefix asks for it: most nodes are
        inside tokens and are never asked for.
        """
        inner, final, pairs, apart = self.inner, self.final, self.pairs, self.stay_apart
        inner_sizes, final_sizes = self.inner_sizes, self.final_sizes
        out, path = {}, ""
        last: list[int] = [-1]   # last[d]: last token of the path's prefix of d letters (-1: not asked for yet)
        size: list[int] = [0]    # and its number of letters

        def state(d: int) -> int:
            ending = word[d - 3 if d > 3 else 0:d]
            for n in inner_sizes.get(ending) or inner_sizes.get(ending[1:]) or (1,):
                if n > d:
                    continue
                token = inner.get(word[d - n:d])
                if token is not None:
                    if n == d:
                        break
                    left = last[d - n]
                    if left < 0:
                        left = state(d - n)
                    fits = pairs.get(left << PAIR_BITS | token)
                    if fits or fits is None and apart(left, token):
                        break
            last[d], size[d] = token, n
            return token

        for word in sorted(words):
            token, length, common = final.get(word), len(word), 0
            if token is not None:
                out[word] = [token]
                continue
            limit = min(len(path), length - 1)
            while common < limit and path[common] == word[common]:
                common += 1
            fresh = length - 1 - common
            last[common + 1:], size[common + 1:] = [-1] * fresh, [0] * fresh
            path = word[:-1]
            if length > DEEP:  # in order, so that no state waits for a long row of others
                for d in range(1, length):
                    if last[d] < 0:
                        state(d)
            ending = word[-3:]
            for n in final_sizes.get(ending) or final_sizes.get(ending[1:]) or (1,):
                if n >= length:
                    continue
                token = final.get(word[length - n:])
                if token is not None:
                    left = last[length - n]
                    if left < 0:
                        left = state(length - n)
                    fits = pairs.get(left << PAIR_BITS | token)
                    if fits or fits is None and apart(left, token):
                        break
            ids, d = [token], length - n
            while d:
                if last[d] < 0:
                    state(d)
                ids.append(last[d])
                d -= size[d]
            ids.reverse()
            out[word] = ids
        return out

    def _pieces(self, text: str) -> list[str]:
        """Pre-tokens and special strings (after a blank, which no pre-token has), in order."""
        bpe = self.bpe
        if not bpe.has_special(text):
            return pre_tokens(text)
        return [w for part in bpe.parts(text)
                for w in ([" " + part] if part in bpe.specials else pre_tokens(part))]

    def _find(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of distinct pieces: from the two generations of the cache, or encoded now."""
        bpe = self.bpe
        if len(self.ids) >= CACHE_WORDS:  # what is used again comes back from the older generation
            self.ids, self.older = {}, self.ids
        ids, older = self.ids, self.older
        missing = pieces - ids.keys()
        again = missing & older.keys()
        ids.update((w, older[w]) for w in again)
        spelt = {}
        for w in missing - again:
            if w[0] == " ":
                ids[w] = bpe.specials[w[1:]].to_bytes(4, "little")
            else:
                spelt[bpe.letters(w)] = w
        for letters, tokens in self.encode_words(set(spelt)).items():
            ids[spelt[letters]] = struct.pack(f"<{len(tokens)}I", *tokens)
        return ids

    def forget(self) -> None:
        self.ids, self.older, self.pairs = {}, {}, {}

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, 4 bytes each."""
        pieces = [self._pieces(t) for t in texts]
        find = self._find(set(chain.from_iterable(pieces))).__getitem__
        return [b"".join(map(find, p)) for p in pieces]

    def decode_texts(self, ids: list[bytes]) -> pa.Array:
        """Token strings of each text joined by spaces: the file names no decoder, so the library joins them as they are."""
        tokens = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), self.strings.take(pa.array(tokens))), " ")

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded string of each text."""
        ids = self.encode_texts(texts)
        return ids, self.decode_texts(ids).to_pylist()


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(load(path))
    return _ENCODERS[path]


def bpe_encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (binary: little-endian, 4 bytes each) and ``decoded`` of each text.

    ``tokenizer`` is the path of a vocabulary file, as seen by the executors.
    """

    def make():
        enc = encoder(tokenizer)

        def step(ids, texts):
            tokens = enc.encode_texts(texts)
            return [ids, [len(t) // 4 for t in tokens], tokens, enc.decode_texts(tokens)]
        return step

    return per_text(docs, "doc_id long, n_tokens long, ids binary, decoded string", make, SLICE,
                    lambda: encoder(tokenizer).forget())


def bpe_decode(tokens: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``: the string of each token of an array of ids, joined by spaces.

    The file names no decoder, so the library joins token strings as they are.
    """
    @F.pandas_udf("string")
    def decode(column):
        strings = load(tokenizer).strings
        return column.map(lambda seq: None if seq is None else " ".join([strings[i] for i in seq]))

    return tokens.withColumn("decoded", decode(F.col(ids)))
