"""Operator 12 against all pairs of fingerprints, counted plainly."""

import random
import re

import numpy as np
import pytest
import xxhash

from stagecraft.llm import op12_simhash as op12

from .util import docs_of, empty_docs, odd_docs


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [least.get(root(i)) for i in range(len(prints))]


def clustered(rng, n):
    """Fingerprints in clusters of a few changed bits, with chains and stray ones."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
    return out[:n]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def prints_table(spark, prints):
    return spark.createDataFrame([(signed(x),) for x in sorted(set(prints))], "fp long")


def groups(edges, prints):
    parent = {x: x for x in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = root(a % (1 << 64)), root(b % (1 << 64))
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in prints}


@pytest.mark.parametrize("limit", [op12.LEAVES, 12, 2])
def test_links_join_all_pairs_in_the_budget(spark, limit):
    rng = random.Random(limit)
    # A dense ball: one centre, up to four bits changed, so subtrees are cut again and again at a small limit.
    centre = rng.getrandbits(64)
    ball = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)]
    prints = list(dict.fromkeys(clustered(rng, 200) + ball + [0, (1 << 64) - 1, 7, 1 << 63]))
    edges = op12.links(prints_table(spark, prints), limit).collect()
    assert all(a != b for a, b in edges)
    found = groups(edges, prints)
    want = brute_components(prints, prints)
    same = {}
    for x, w in zip(prints, want):
        assert same.setdefault(w, found[x]) == found[x]
    assert len(set(found.values())) == len(set(want))


def test_walk_finds_every_link(monkeypatch):
    monkeypatch.setattr(op12, "DIRECT", 1)
    monkeypatch.setattr(op12, "WIDE", 16)
    for seed in range(6):
        rng = random.Random(seed)
        leaves = np.array(sorted(set(x >> 48 for x in clustered(rng, 300))), np.uint64)
        n = len(leaves)
        label = op12.walk(leaves, 16, (np.array([0]), np.array([n]), np.array([0]), np.array([n]), np.array([0])))
        assert label.tolist() == [brute_components(range(n), leaves.tolist())[i] for i in range(n)]


def test_equals_brute_force_on_texts(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgé", k=rng.randint(2, 7))) for _ in range(400)]
    texts = [None, "", " \t\n", "One", "one two", "ONE  two", "a b c", "É   x y", "\x1c a b"]
    for _ in range(40):
        base = rng.choices(words, k=rng.randint(3, 300))
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(rng.choice([" ", "\n", "  "]).join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    prints = [brute_fingerprint(t) for t in texts]
    want = brute_components(range(len(texts)), prints)
    got = {r["doc_id"]: r for r in op12.report(op12.near_duplicates(docs_of(spark, texts))).collect()}
    for i, (p, c) in enumerate(zip(prints, want)):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{p:016x}", c), i


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(random.Random(1).choices(["ab", "c", "defg", "h" * 90], k=3000))
    want = brute_fingerprint(text)
    for segment in (1, 7, 64, 1000):
        monkeypatch.setattr(op12, "SEGMENT", segment)
        assert op12.fingerprint(text.encode()) == want


def test_odd_tables(spark):
    assert op12.report(op12.near_duplicates(empty_docs(spark))).collect() == []
    rows = op12.report(op12.near_duplicates(odd_docs(spark))).collect()
    assert len(rows) == odd_docs(spark).count()
    empty = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(empty) == 3 and {r["component_id"] for r in empty} == {1}  # null, empty, and the row without an id
    assert [r["component_id"] for r in rows if r["doc_id"] == 3] == [3, 3]
    lone = spark.createDataFrame([(None, "no id here")], "doc_id long, text string")
    assert op12.report(op12.near_duplicates(lone)).collect()[0]["component_id"] is None
