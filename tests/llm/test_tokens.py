"""Operators 1 and 6 against the tokenizer library."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stagecraft.llm import op1_bpe, op6_token_counts, word_bpe
from stagecraft.llm.word_bpe import load

from .util import by_id, docs_of, empty_docs, odd_docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n: int = 400) -> list[str]:
    rng = random.Random(3)
    letters = [*"aabbe'sStTrevmlld  \n\t\x1c\x85　éÉßΣςİñ1²٣中文😀<|startoftext|>!..,-_\0\x7f", "<|endoftext|>", "the", "'re"]
    return ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(n)]


def test_trie_equals_library(library):
    texts = random_texts()
    ids, decoded = op1_bpe.encoder(PATH).encode(texts)
    for t, i, d in zip(texts, ids, decoded):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(i, "<u4").tolist() == want
        assert d == library.decode(want, skip_special_tokens=False)


def test_trie_equals_plain_merging():
    bpe = load(PATH)
    rng = random.Random(5)
    words = {"".join(rng.choices("abcdeinost", k=rng.randint(1, 14))) for _ in range(500)} | {"a" * n for n in range(1, 30)}
    assert op1_bpe.encoder(PATH).encode_words(words) == {w: bpe.merge(bpe.symbols(w)) for w in words}


def test_codec_and_counts_on_documents(spark, library):
    texts = [*random_texts(50), "A word, two words!", None, ""]
    docs = docs_of(spark, texts)
    coded = by_id(op1_bpe.bpe_encode_decode(docs, PATH), "n_tokens", "ids", "decoded")
    counts = by_id(op6_token_counts.token_report(docs, PATH, 10), "n_bytes", "n_tokens", "over_limit")
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        n, ids, decoded = coded[i]
        assert n == len(want) and np.frombuffer(bytes(ids), "<u4").tolist() == want
        assert decoded == library.decode(want, skip_special_tokens=False)
        assert counts[i] == (len((t or "").encode()), len(want), len(want) > 10)


def test_decode_arrays(spark, library):
    want = library.encode("Some tokens <|endoftext|>", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, want), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = by_id(op1_bpe.bpe_decode(df, PATH), "decoded")
    assert got == {1: library.decode(want, skip_special_tokens=False), 2: None, 3: ""}


def test_query_digests(spark, tmp_path):
    from stagecraft.llm.queries import op1_bpe_codec
    docs_of(spark, ["abc def", None]).write.parquet(str(tmp_path / "documents.parquet"))
    got = by_id(op1_bpe_codec(spark, str(tmp_path)), "n_tokens", "ids_sha256")
    assert got[1] == (0, hashlib.sha256(b"").hexdigest())


def test_odd_tables(spark):
    for op in (op1_bpe.bpe_encode_decode, op6_token_counts.count_tokens):
        assert op(odd_docs(spark), PATH).count() == 8
        assert op(empty_docs(spark), PATH).count() == 0


def test_whole_tokens_are_one_token():
    bpe = load(PATH)
    whole = op6_token_counts.whole_tokens(PATH)
    assert len(whole) > 10_000
    assert all(len(bpe.merge(bpe.symbols(w))) == 1 for w in random.Random(1).sample(sorted(whole), 200))


def test_a_known_word_is_not_encoded_again(library, monkeypatch):
    enc, asked = op1_bpe.TrieEncoder(load(PATH)), []
    encode_words = op1_bpe.TrieEncoder.encode_words
    monkeypatch.setattr(op1_bpe.TrieEncoder, "encode_words", lambda self, words: (asked.append(set(words)), encode_words(self, words))[1])
    for text in ["unknowable plain é Ã©", "Unknowable, plain! É Ã© plain<|endoftext|>"]:
        ids, _ = enc.encode([text])
        assert np.frombuffer(ids[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert "unknowable" in asked[0] and not {"unknowable", "plain"} & asked[1]


def test_long_words_merge_as_short_ones(monkeypatch):
    bpe, rng = load(PATH), random.Random(8)
    words = ["".join(rng.choices(letters, k=n)) for letters in ("x", "ab", "etaoins") for n in (3, 63, 64, 65, 66, 300, 701)]
    fast = [bpe.merge(bpe.symbols(w)) for w in words]
    began = time.process_time()
    assert sum(len(bpe.strings[t].removesuffix("</w>")) for t in bpe.merge(bpe.symbols("x" * 30_000))) == 30_000
    assert time.process_time() - began < 10  # steps grow with n log n, not with its square
    monkeypatch.setattr(word_bpe, "PLAIN", 10_000)
    assert fast == [bpe.merge(bpe.symbols(w)) for w in words]


def test_a_word_is_encoded_once_whatever_stands_around_it(library, monkeypatch):
    enc, asked = op1_bpe.TrieEncoder(load(PATH)), []
    encode_words = op1_bpe.TrieEncoder.encode_words
    monkeypatch.setattr(op1_bpe.TrieEncoder, "encode_words", lambda self, words: (asked.append(set(words)), encode_words(self, words))[1])
    for text in ["(Unknowabled, überqueren!", "UNKNOWABLED'S; Überqueren? unknowabled/überqueren"]:
        ids, _ = enc.encode([text])
        assert np.frombuffer(ids[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert "unknowabled" in asked[0] and not {w for w in asked[1] if "unknow" in w or "berqueren" in w}


def test_whole_texts_are_normalised_as_their_parts(library):
    texts = ["<|ENDOFTEXT|> <|endoftext|>É<|startoftext|>é <|EndOfText|>", "ΑΣ Σ ΟΔΟΣ's", "a ́b　̸= ≮", "ᄀ ᅡ 가",
             " x `;", "İ İ", "a\x1cb\x1fc \x85d\x0be", " \t\n", "it's IT'S 'LL 'll'd 'dog ''s'", "١٢ ²½Ⅷ 一二",
             *("".join(chr(c) + t for c in range(128)) for t in ("", "a", "'s", " "))]
    ids, decoded = op1_bpe.encoder(PATH).encode(texts)
    for t, i, d in zip(texts, ids, decoded):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(i, "<u4").tolist() == want
        assert d == library.decode(want, skip_special_tokens=False)


def test_long_words_in_the_trie():
    bpe, rng = load(PATH), random.Random(9)
    words = {"".join(rng.choices(letters, k=n)) for letters in ("x", "ab", "etaoins") for n in (63, 64, 65, 66, 300, 5_000)}
    words |= {w + "s" for w in words} | {w[:-1] for w in words}
    assert op1_bpe.encoder(PATH).encode_words(words) == {w: bpe.merge(bpe.symbols(w)) for w in words}
