"""Operators 2, 5, 9 and 10 against plain Python, and their decisions on planted cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagecraft.llm import op2_toxicity as op2, op5_quality_rules as op5, op9_quality as op9, op10_decontaminate as op10
from stagecraft.llm import postings

from .util import by_id, docs_of, empty_docs, labels_of, odd_docs


def test_varints_round_trip():
    rng = np.random.default_rng(1)
    v = np.concatenate([[0, 1, 127, 128, 16383, 16384, 2**40], rng.integers(0, 2**50, 500)])
    data, ends = postings.put_varints(v)
    got, got_ends = postings.get_varints(data)
    assert got.tolist() == v.tolist() and got_ends.tolist() == ends.tolist()
    s = np.array([0, -1, 1, -5, 1000, -2**40])
    assert postings.unzigzag(postings.zigzag(s)).tolist() == s.tolist()


@pytest.mark.parametrize("bits, texts", [(1, 500), (3, 500), (1, 9), (3, 9), (3, 8000)])
def test_postings_round_trip(bits, texts):
    rng = np.random.default_rng(2)
    unit, doc = rng.integers(0, 40, 2000), rng.integers(0, texts, 2000)
    names, post = postings.pack_pairs(unit, doc, bits)
    row, d, count = postings.unpack_pairs(post)
    assert Counter(dict(zip(zip(names[row].tolist(), d.tolist()), count.tolist()))) == Counter(zip(unit.tolist(), doc.tolist()))
    row, d, _ = postings.unpack_pairs(post.slice(5, 7))  # a slice starts at its own offset
    assert set(zip(names[5:12][row].tolist(), d.tolist())) == {(u, x) for u, x in zip(unit.tolist(), doc.tolist()) if u in names[5:12]}


def kneser_ney(trusted: list[str], texts: list[str]) -> list[float]:
    """Sum of -log p of each text under the plain form of the model of operator 9."""
    def framed(t):
        return "\x02\x02" + " ".join(t.split()) + "\x03"
    grams = Counter(f[i:i + 3] for f in map(framed, trusted) for i in range(len(f) - 2))
    two = Counter(g[1:] for g in grams)
    one = Counter(g[1:] for g in two)
    letters = {f[i] for f in map(framed, texts) for i in range(2, len(f))}

    def discounts(c):
        n = [sum(v == k for v in c.values()) for k in range(5)]
        if not n[1] + 2 * n[2]:
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) if n[k] else 0.5 for k in (1, 2, 3)]

    def order(c):
        d = discounts(c)
        total, left = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            left[g[:-1]] += d[min(v, 3) - 1]
        return {g: (v - d[min(v, 3) - 1]) / total[g[:-1]] for g, v in c.items()}, {h: left[h] / total[h] for h in total}
    (p3, l3), (p2, l2), (p1, l1) = order(grams), order(two), order(one)
    out = []
    for f in map(framed, texts):
        s = 0.0
        for i in range(len(f) - 2):
            g = f[i:i + 3]
            low = p1.get(g[2], 0) + l1[""] / (len(letters) + 1)
            mid = p2.get(g[1:], 0) + l2.get(g[1], 1) * low
            s -= math.log(p3.get(g, 0) + l3.get(g[:2], 1) * mid)
        out.append(s)
    return out


def test_perplexity_equals_plain_model(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeñ", k=rng.randint(1, 6))) for _ in range(80)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)] + ["QQ!! ZZ!!", "", "\t x \n y"]
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    got = by_id(op9.perplexities(docs_of(spark, texts), trusted), "nll", "n")
    want = kneser_ney(texts[0:60:2], texts)
    for i, w in enumerate(want):
        assert got[i][1] == len(" ".join(texts[i].split())) + 1
        assert got[i][0] == pytest.approx(w, rel=1e-3, abs=0.05), i


def test_quality_keeps_clean_and_rejects_junk(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(200)]
    clean = [" ".join(rng.choices(words, k=rng.randint(30, 90))) + "." for _ in range(120)]
    junk = [" ".join(w.upper() + "!!" for w in rng.choices(words, k=60)) for _ in range(10)]
    docs = docs_of(spark, [*clean, *junk, "", None])
    labels = labels_of(spark, [(i, 1, 0) for i in range(80)] + [(120, 0, 0)])
    kept = by_id(op9.classify(docs, labels), "kept")
    assert not any(kept[i] for i in range(120, 130))
    assert sum(kept[i] for i in range(120)) >= 119 and kept[130] and kept[131]
    out = op9.keep(docs, labels)
    assert out.columns == docs.columns and out.count() == sum(kept.values())
    assert op9.classify(docs, labels_of(spark, [])).where("kept").count() == 132


def word_evidence(counts: dict[str, tuple[int, int]]):
    """The model of operator 2 in plain Python: log-likelihood difference of any word."""
    def cut(w):
        return w[:op2.STEM], w[op2.STEM:]
    kinds, pooled = Counter(), Counter()
    for w, c in counts.items():
        kinds[cut(w)[0]] += 1
        pooled[cut(w)[0]] += sum(c)
    models = []
    for k in (0, 1):
        seen = {w: c[k] for w, c in counts.items() if c[k]}
        n1, n2 = sum(v == 1 for v in seen.values()), sum(v == 2 for v in seen.values())
        d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 + 2 * n2 else 0.5
        stem, types = Counter(), Counter()
        for w, v in seen.items():
            stem[cut(w)[0]] += v
            types[cut(w)[0]] += 1
        models.append((seen, d, stem, types, sum(seen.values())))

    def difference(word):
        s = cut(word)[0]
        logs = []
        if s not in kinds:
            return 0.0  # a stem that training has not seen speaks for neither class
        for seen, d, stem, types, n in models:
            left = d * len(stem) / n
            p = max(stem[s] - d, 0) / n + left * kinds[s] / len(counts)
            back = d * types[s] / stem[s] if stem[s] else 1.0
            own = max(seen.get(word, 0) - d, 0) / stem[s] if stem[s] else 0.0
            share = sum(counts[word]) / pooled[s] if word in counts else 1.0
            logs.append(math.log(p) + math.log(own + back * share))
        return logs[0] - logs[1]
    return difference


def test_toxicity_features_equal_plain_model(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcd", k=rng.randint(2, 8))) for _ in range(120)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) + (" Venomous venomed" if i % 5 == 0 else "") for i in range(80)]
    texts += ["unseen stems here", "venomish", ""]
    docs, labels = docs_of(spark, texts), labels_of(spark, [(i, 1, int(i % 5 == 0)) for i in range(80)])
    folds = {r[0]: r[1] for r in docs.select("doc_id", op2.fold(F.col("doc_id"))).collect()}
    counts = defaultdict(lambda: [0, 0])
    for i in range(80):
        if folds[i] in (0, 1):
            for w in re.findall("[a-z]+", texts[i].lower()):
                counts[w][0 if i % 5 == 0 else 1] += 1
    difference = word_evidence({w: tuple(c) for w, c in counts.items()})
    got = by_id(op2.features(docs, labels), "n", "llr", "clear")
    for i, t in enumerate(texts):
        want = [difference(w) for w in re.findall("[a-z]+", t.lower())]
        assert got[i][0] == len(want)
        assert got[i][1] == pytest.approx(sum(want), abs=0.002 * max(len(want), 1))
        assert got[i][2] == pytest.approx(sum(max(x - op2.CLEAR, 0) for x in want), abs=0.002 * max(len(want), 1))


def test_toxicity_ranks_held_out_texts(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    bad = ["venom" + x for x in ("ous", "ed", "ing", "ish", "al", "ly")]
    toxic = [i % 6 == 0 for i in range(400)]
    texts = [" ".join(rng.choices(words, k=40) + (rng.choices(bad, k=3) if t else [])) for t in toxic]
    docs = docs_of(spark, texts)
    labels = labels_of(spark, [(i, 1, int(t)) for i, t in enumerate(toxic)])
    rows = op2.score(docs, labels).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 400 and 50 < len(held) < 150
    assert all((r["predicted"] == 1) == toxic[r["doc_id"]] for r in held)
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn("toxic", F.when(op2.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert by_id(op2.score(docs, flipped), "score") == by_id(op2.score(docs, labels), "score")


def plain_measures(t: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    seen, dups = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dups, len(hit)


def test_measures_equal_plain_ones(spark):
    rng = random.Random(7)
    parts = ["a", "b", "cc", "é", "\xa0", " ", " ", " ", "\n", "\n", "\t", "\x0b", "#", "|", "<", "a b c d e ", "x\n", "\x1c"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(300)] + ["", None]
    got = by_id(op5.measures(docs_of(spark, texts)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, t in enumerate(texts):
        assert got[i] == plain_measures(t or ""), repr(t)


def test_bound_is_exact():
    assert op5.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01, abs=1e-9)
    p = op5.upper_bound(3, 50, 0.01)
    assert sum(math.comb(50, k) * p ** k * (1 - p) ** (50 - k) for k in range(4)) == pytest.approx(0.01, rel=1e-6)
    assert op5.upper_bound(5, 5, 0.01) == op5.upper_bound(0, 0, 0.01) == 1.0


def test_cutoffs_hold_their_risk(spark):
    rows = [(i, "en", 100, 500, 1 if i % 50 else 0, 0, 0, 10, 0, 20) for i in range(8000)] + [(9000, "xx", 100, 500, 1, 0, 0, 10, 0, 20)]
    measured = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in op5._COLUMNS))
    labels = spark.range(9001).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    got = {(r["lang"], r["rule"]): r["cutoff"] for r in op5.cutoffs(measured, labels).collect()}
    assert got[("en", "symbols")] == 0.01 and got[("en", "capitals")] == 0.02 and got[("en", "repeats")] == 0.0
    assert not any(lang == "xx" for lang, _ in got)  # one text proves nothing


def test_small_strata_get_cutoffs(spark):
    """Four languages of 297 good labels each have cutoffs; one label less has none."""
    sizes = {"de": 297, "en": 2000, "es": 297, "fr": 296}
    rows = [(10_000 * k + i, lang, 100, 500, 0, 0, 0, 10, 0, 20) for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    measured = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in op5._COLUMNS))
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    got = {(r["lang"], r["rule"]): r["cutoff"] for r in op5.cutoffs(measured, labels).collect()}
    assert {lang for lang, _ in got} == {"de", "en", "es"} and len(got) == 15
    assert got[("es", "symbols")] == 0.0 and got[("es", "capitals")] == 0.02


def test_rules_keep_and_reject(spark):
    docs = docs_of(spark, ["one two three four five six seven eight nine ten eleven", "short", None, "a b c d e " * 10])
    got = by_id(op5.apply_rules(docs, labels_of(spark, [(0, 1, 0)])), "base_failed", "kept")
    assert got == {0: (False, True), 1: (True, False), 2: (True, False), 3: (True, False)}


ITEM = "If Tom has 12 apples and Ann gives him 7 more apples how many apples does Tom have then"


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_leaks_of_copies_and_new_parameters(spark):
    other = "it was a plain day and nobody in the town had seen such rain before the long summer came"
    texts = [f"Some prose first. {ITEM}? And more.", ITEM.replace("Tom", "Bob").replace("12", "90").replace("7", "31"),
             ITEM.replace("Tom", "Bob", 1), other, "", None, f"{ITEM} {ITEM.replace('Ann', 'Eve')}"]
    rows = op10.leaks(docs_of(spark, texts), bench(spark, ITEM, "too short", None, "")).collect()
    # Text 2 names one person in two ways where the item has one name: another question.
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(0, 0), (1, 0), (6, 0)}
    assert all(r["share"] >= 0.5 and r["n_slots"] >= 3 for r in rows)
    left = op10.clean(docs_of(spark, texts), bench(spark, ITEM))
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 5]


def test_leaks_of_edited_and_partial_copies(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    a, b, c = words[:20], words[20:37], words[40:99]
    items = [" ".join(x) for x in (a, b, c)] + [ITEM]
    texts = [" ".join([*words[100:120], *a[:10], "inserted", *a[10:], *words[120:140]]), " ".join([*a[:9], *a[10:]]),  # a word put in, left out
             " ".join([*b[:8], "replaced", *b[9:]]), " ".join([*words[150:180], *c[20:45], *words[180:200]]),
             ITEM.replace("Tom", "Mary Ann").replace("12", "5 000"),
             " ".join([*words[200:230], *c[:9], *words[230:260]]), " ".join([*a[10:18], *words[300:330], *a[:8]])]
    rows = op10.leaks(docs_of(spark, texts), bench(spark, *items)).collect()
    # Nine words of 59, and two passages in the other order, are no copies.
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 3)}


def test_slots_of_a_copy_are_a_function_with_few_exceptions(spark):
    few = "If there are 3 red boxes and 5 blue boxes on the table how many boxes are there"
    long = "when Tom met Ann at noon, Tom gave 12 coins to Ann and then Tom asked Ann for 7 more so Ann told Tom no"
    rows = op10.leaks(docs_of(spark, [few.replace("3", "4").replace("5", "4"), long.replace("Tom", "Tim", 1)]), bench(spark, few, long)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(0, 0), (1, 1)}
    assert op10.consistent({(i, "3Tom"): (i, "3Tim" if i else "3Tom") for i in range(7)})
    assert not op10.consistent({(i, "3Tom"): (i, "3Tim" if i else "3Tom") for i in range(6)})


def test_chains_follow_small_changes_of_distance():
    line = [(100 + i, i) for i in range(5)] + [(102 + i, i) for i in range(5, 9)] + [(500, 9)]
    assert max(map(len, op10.chains(line))) == 9


def test_leaks_name_all_items_of_a_template(spark):
    plain = ITEM.lower().replace("12", "some").replace("7", "a few")
    rows = op10.leaks(docs_of(spark, [plain]), bench(spark, plain, plain, "other words entirely " * 5)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(0, 0), (0, 1)}


@pytest.mark.parametrize("make", [odd_docs, empty_docs])
def test_odd_tables(spark, make):
    docs, labels = make(spark), labels_of(spark, [(1, 1, 0), (3, 1, 1), (3, 0, 0), (None, None, None), (2, None, None)])
    n = docs.count()
    for labels_ in (labels, labels_of(spark, [])):
        assert op2.score(docs, labels_).count() == n
        assert op5.apply_rules(docs, labels_).count() == n
        assert op9.classify(docs, labels_).count() == n
    assert op10.leaks(docs, bench(spark, ITEM)).count() == 0
    assert op10.clean(docs, bench(spark)).columns == docs.columns
