"""Operator 6: token counts with a whole-token shortcut.

Before any text is read, merging each vocabulary string on its own proves
which of them encode alone as one token. A pre-token in that set counts one
without merging. Only the rest is merged, once per distinct pre-token that a
Python worker sees (a cache of bounded size). Map-only: nothing is shuffled.

Cases: a null or empty text has 0 bytes and 0 tokens. Repeated rows each give
their own row. Other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from .common import per_text
from .word_bpe import WORD_END, load

#: Counted chunks, and merged pre-tokens, that one Python worker keeps.
CACHE_ENTRIES = 800_000


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """Pre-tokens that encode as one token, each proved by merging its symbols."""
    bpe = load(path)
    ends = (s.removesuffix(WORD_END) for s in bpe.vocab if s.endswith(WORD_END))
    return frozenset(w for w in ends if w and len(bpe.merge(bpe.symbols(w))) == 1)


class TokenCounter:
    def __init__(self, path: str):
        self.bpe, self.whole = load(path), whole_tokens(path)
        self.chunks: dict[str, int] = {}
        self.rest: dict[str, int] = {}

    def _word(self, word: str) -> int:
        """Tokens of a pre-token: one by the shortcut, else by merging once."""
        if word in self.whole:
            return 1
        n = self.rest.get(word)
        if n is None:
            if len(self.rest) >= CACHE_ENTRIES:
                self.rest.clear()
            n = self.rest[word] = len(self.bpe.merge(self.bpe.symbols(word)))
        return n

    def count(self, text: str) -> int:
        known, total, bpe = self.chunks, 0, self.bpe
        for c in bpe.pieces(text):
            n = known.get(c)
            if n is None:
                if len(known) >= CACHE_ENTRIES:
                    known.clear()
                n = known[c] = 1 if c in bpe.specials else sum(map(self._word, bpe.words(c)))
            total += n
        return total


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text."""

    def make():
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = TokenCounter(tokenizer)
        counter = _COUNTERS[tokenizer]

        def step(ids, texts):
            return [ids, [len(t.encode("utf-8")) for t in texts], [counter.count(t) for t in texts]]
        return step

    return per_text(docs, "doc_id long, n_bytes long, n_tokens long", make)


def token_report(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    return count_tokens(docs, tokenizer).withColumn("over_limit", F.col("n_tokens") > limit)
