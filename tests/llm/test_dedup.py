"""Operator 4 against a brute force over all strings, and operator 8 against all pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stagecraft.llm import op4_suffix_dedup as op4
from stagecraft.llm import op8_jaccard_join as op8
from stagecraft.llm.components import components

from .util import by_id, docs_of, empty_docs, odd_docs


def brute(texts: list[bytes]) -> list[tuple]:
    n = op4.LENGTH
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept))
    return out


def planted_texts(seed: int, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(300)]

    def prose(k):
        return " ".join(rng.choices(words, k=k))
    passages = [prose(rng.randint(30, 120)) for _ in range(6)]
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3 and out:  # a near copy: some letters changed
            t = list(rng.choice(out))
            for _ in range(rng.randint(0, 5)):
                if t:
                    t[rng.randrange(len(t))] = rng.choice("XYZ")
            out.append("".join(t))
        elif kind < 0.6:
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            out.append(prose(rng.randint(0, 90)) + p[cut:len(p) - rng.randint(0, 60)] + prose(rng.randint(0, 90)))
        elif kind < 0.7:
            out.append("ab" * rng.randint(50, 400))
        elif kind < 0.8:
            out.append(prose(70) + " " + prose(3) * rng.randint(1, 40))
        else:
            out.append(prose(rng.randint(0, 200)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_equals_brute_force(spark, seed):
    texts = planted_texts(seed)
    want = brute([t.encode() for t in texts])
    got = by_id(op4.dedup(docs_of(spark, texts)), "n_bytes", "n_removed", "n_spans", "kept")
    for i, w in enumerate(want):
        assert (*got[i][:3], bytes(got[i][3])) == w, i


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(op4, "BUFFER", 4096)
    rng = random.Random(4)
    shared = "".join(rng.choices("abcdefgh ", k=9000))
    texts = [shared, "x" * 500 + shared[100:8000], "".join(rng.choices("abcdefgh ", k=20_000))]
    datas = [t.encode() for t in texts]
    spans = []
    for data, owner, begin, index, offset in op4.buffers(datas):
        start, last, _, _ = op4.phrases(data, owner)
        shift = offset[owner[start]] - begin[owner[start]]
        spans += zip(index[owner[start]].tolist(), (start + shift).tolist(), (last + shift).tolist())
    for i, t in enumerate(datas):  # each string is in one phrase
        covered = Counter(s for o, a, b in spans if o == i for s in range(a, b + 1))
        assert covered == Counter(range(len(t) - op4.LENGTH + 1))


def test_dedup_odd_tables(spark):
    rows = op4.dedup(odd_docs(spark)).collect()
    assert len(rows) == 8
    assert {r["doc_id"]: r["n_removed"] for r in rows}[2] == 80_000  # 'a a a ...' repeats itself
    assert op4.dedup(empty_docs(spark)).count() == 0


def jaccard(a: str, b: str) -> float:
    def grams(t):
        w = t.split()
        n = min(5, len(w))
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def near_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 120))] for _ in range(25)]
    out = []
    for b in base:
        for _ in range(rng.randint(1, 12)):
            t = list(b)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
    return out


@pytest.mark.parametrize("block", [128, 3])
def test_join_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(op8, "BLOCK", block)
    texts = near_texts(1)
    got = by_id(op8.join(docs_of(spark, texts)), "class_id", "n_links")
    n = len(texts)
    linked = [[i != j and jaccard(texts[i], texts[j]) >= 0.8 for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in range(n) if linked[i][j])]) for i in range(n)]
        if new == root:
            break
        root = new
    assert [got[i][0] for i in range(n)] == root
    assert [got[i][1] for i in range(n)] == [sum(x) for x in linked]


def test_one_of_each_and_odd_tables(spark):
    docs = docs_of(spark, ["a b c d e f g", "a b c d e f g", "h i j k l m", "", None, ""])
    kept = sorted(r["doc_id"] for r in op8.one_of_each(docs).collect())
    assert kept == [0, 2, 3, 4, 5]
    assert op8.join(odd_docs(spark)).count() == 8
    assert op8.join(empty_docs(spark)).count() == 0
    assert op8.one_of_each(odd_docs(spark)).columns == odd_docs(spark).columns


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (100, 95), (95, 80)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[95] == got[90] == 80


def test_banding_reaches_its_recall():
    assert 1 - (1 - op8.THRESHOLD ** op8.ROWS) ** op8.BANDS >= op8.RECALL


def test_digest_is_of_kept_bytes(spark, tmp_path):
    from stagecraft.llm.queries import op4_suffix_dedup_query
    docs_of(spark, ["q" * 150, None]).write.parquet(str(tmp_path / "documents.parquet"))
    got = by_id(op4_suffix_dedup_query(spark, str(tmp_path)), "kept_sha256")
    assert got == {0: hashlib.sha256(b"q" * 150).hexdigest(), 1: hashlib.sha256(b"").hexdigest()}
