"""Operators 3 and 7 against Python's regular expressions, and their models' decisions."""

import hashlib
import math
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from stagecraft.llm import op3_secrets, op7_pii

from .util import by_id, docs_of, empty_docs, labels_of, odd_docs


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def secret_base(text: str) -> str:
    found = []
    for m in re.finditer(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(x[2] for x in sorted(found))


def personal_base(text: str) -> str:
    found = [(m.start(), 0, f"email:{m.start()}:{m.end()}") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, f"ip:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, order, pattern, low, high in (("card", 2, r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def noise(parts: list[str], n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


def test_secret_patterns(spark):
    texts = noise(["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", "\"", "'", " ", "  ", "abc", "AKIA", "AKIA" + "Z9" * 9,
                   "0123456789abcdef" * 2, "deadbeef", "é", "😀", "a.b/c+d", "\n", "x" * 7], 600, 1)
    docs = docs_of(spark, texts)
    got = by_id(op3_secrets.report(op3_secrets.scan(docs, labels_of(spark, [(0, 1, 0)]))), "base_sha256", "spans")
    for i, t in enumerate(texts):
        assert got[i][0] == hashlib.sha256(secret_base(t).encode()).hexdigest(), t
        assert set(filter(None, secret_base(t).split(","))) <= set(got[i][1].split(","))


def test_personal_patterns(spark):
    texts = noise(["a.b", "@", "x-y", ".com", ".", "1", "25", "256", "1.2.3.4", "4111 1111 1111 1111", "4111-1111", "+1", "+", "(", ")", " ", "-",
                   "555", "12", "_d@e.f", "é", "😀", "0007", "%"], 800, 2)
    got = by_id(op7_pii.report(op7_pii.scan(docs_of(spark, texts))), "base_sha256")
    for i, t in enumerate(texts):
        assert got[i] == hashlib.sha256(personal_base(t).encode()).hexdigest(), t


def test_markov_finds_random_strings_only(spark):
    rng = random.Random(9)
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def random_key(n):
        return "".join(rng.choices(key, k=n))
    words = ["configuration", "identifier", "maximum_number", "request", "handler", "connection", "pool", "version"]
    texts = [f"{' '.join(rng.choices(words, k=20))} token={random_key(40)} {' '.join(rng.choices(words, k=20))}" for _ in range(60)]
    plain, secret = "the configuration_handler_version2_request is", f"see {random_key(36)}7a for it"
    docs = docs_of(spark, [*texts, plain, secret])
    found = by_id(op3_secrets.report(op3_secrets.scan(docs, labels_of(spark, [(i, 1, 0) for i in range(62)]))), "spans")
    assert found[60] == "" and found[61].startswith("markov:4:")
    clean = by_id(op3_secrets.redact(docs, labels_of(spark, [(i, 1, 0) for i in range(62)])), "text")
    assert clean[61] == "see [markov] for it" and clean[60] == plain
    assert all("token=" not in clean[i] and "[assign]" in clean[i] for i in range(60))


def test_terms_that_reveal_an_entity(spark):
    filler = ["alpha beta gamma delta words here", "other plain words are here", "nothing to see in this text"]
    close = [f"{filler[i % 3]} zebrafish Quixotic ann@x.org {filler[(i + 1) % 3]}" for i in range(4)]
    docs = docs_of(spark, [*close, *[f"{f} number {i}" for i in range(40) for f in filler]])
    got = by_id(op7_pii.report(op7_pii.scan(docs)), "spans")
    assert "term:" in got[0] and "name:" in got[0] and "email:" in got[0]
    assert all(got[i] == "" for i in range(4, 60))
    clean = by_id(op7_pii.sanitise(docs), "text")
    assert "zebrafish" not in clean[0] and "[name] [email]" in clean[0]
    # Copies of one text are no evidence.
    copies = docs_of(spark, [close[0]] * 6 + [f"{f} {i}" for i in range(30) for f in filler])
    assert "term:" not in by_id(op7_pii.report(op7_pii.scan(copies)), "spans")[0]


def test_terms_are_marked_wherever_they_stand(spark):
    """A term reveals its entity at any distance, at a text's edges, in texts without the entity and in rows without an id."""
    filler = [f"plain words about nothing {w} " for w in ("alpha", "beta", "gamma", "delta")]
    texts = [f"zebrafish {filler[i % 4] * (20 + i)} ann@x.org {filler[i % 4]} Quixotic" for i in range(10)]
    texts += [f"{filler[0]} number zebrafish"] + [f"{f} {i}" for i in range(40) for f in filler]
    docs = docs_of(spark, texts).unionByName(docs_of(spark, [texts[0] + " again"]).selectExpr("cast(null AS long) doc_id", "text", "lang", "source", "n_chars"))
    rows = op7_pii.report(op7_pii.scan(docs)).collect()
    got = {r["doc_id"]: r["spans"] for r in rows}
    n = len(filler[0] * 20) + 11
    assert got[0].split(",")[0] == "term:0:9" and f"email:{n}:{n + 9}" in got[0] and got[0].split(",")[-1].startswith("name:")
    assert got[10].startswith("term:") and all(got[i] == "" for i in range(11, 60))
    assert "term:0:9" in got[None] and "email:" in got[None]
    clean = op7_pii.sanitise(docs).collect()
    assert len(clean) == len(rows) and not any("zebrafish" in r["text"] or "ann@" in r["text"] for r in clean)


def test_disclosures_equal_plain_counts(spark, monkeypatch):
    """Every added span against dictionaries over all texts, also where each entity's texts are split."""
    rng = random.Random(12)
    words = [f"w{''.join(rng.choices('abcdefgh', k=4))}" for _ in range(120)]
    people = [f"p{i}@x.org" for i in range(6)]
    texts = []
    for i in range(260):
        who = rng.randrange(6) if i % 2 else None
        body = rng.choices(words[12:], k=12) + ([words[who], words[who + 6].title()] if who is not None and rng.random() < 0.9 else [])
        rng.shuffle(body)
        texts.append(" ".join(body) + (f" {people[who]}" if who is not None else ""))
    texts += texts[:30]  # copies are one text, but rows count
    lower = [set(w.lower() for w in re.findall(r"[^\W\d_]{3,}", re.sub(r"\S+@\S+", " ", t))) for t in texts]
    every = [set(w.lower() for w in re.findall(r"[^\W\d_]{3,}", t)) for t in texts]
    total, disclosing = len(texts), set()
    for e in people:
        rows = [i for i, t in enumerate(texts) if e in t]
        for term in set().union(*(lower[i] for i in rows)):
            both = [i for i in rows if term in lower[i]]
            n_term = sum(term in x for x in every)
            if len({texts[i] for i in both}) >= 3:
                share = math.log2(total * len(both) / (len(rows) * n_term)) / math.log2(total / len(rows))
                if min(share, 1.0) >= op7_pii.SHARE:
                    disclosing.add(term)
    assert disclosing
    for split in (op7_pii.SPLIT_ROWS, 7):
        monkeypatch.setattr(op7_pii, "SPLIT_ROWS", split)
        got = by_id(op7_pii.report(op7_pii.scan(docs_of(spark, texts))), "spans")
        for i, t in enumerate(texts):
            want = {f"{'name' if m[0][0].isupper() else 'term'}:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W\d_]{3,}", t)
                    if m[0].lower() in disclosing and "@" not in t[m.start():m.end() + 1] and t[m.start() - 1:m.start()] not in ("@", ".")}
            assert set(filter(None, got[i].split(","))) - {s for s in got[i].split(",") if s.startswith("email")} == want, t


def test_markov_ratio_equals_plain_counts(spark):
    """The ratio as SQL computes it, against dictionaries; keys of letters alone are found too."""
    rng = random.Random(4)
    counts = [{"".join(rng.choices(op3_secrets.ALPHABET[:n], k=2)): rng.randint(1, 50) for _ in range(300)} for n in (66, 30)]
    models = [op3_secrets.markov(c) for c in counts]
    for m in models:
        for x in op3_secrets.ALPHABET:
            assert abs(sum(math.exp(m[x + y]) for y in op3_secrets.ALPHABET) - 1) < 1e-9
    table = [models[0][x + y] - models[1][x + y] for x in op3_secrets.ALPHABET for y in op3_secrets.ALPHABET]
    strings = ["".join(rng.choices(op3_secrets.ALPHABET, k=rng.randint(2, 60))) for _ in range(50)]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for r in df.select("s", op3_secrets.log_ratio(F.col("s"), table).alias("v")).collect():
        assert abs(r["v"] - sum(models[0][a + b] - models[1][a + b] for a, b in zip(r["s"], r["s"][1:]))) < 1e-9

    words = ["configuration", "identifier", "maximumnumber", "requesthandler", "connectionpool", "internationalisation", "version"]
    letters = string.ascii_letters
    texts = [f"{' '.join(rng.choices(words, k=30))} token={''.join(rng.choices(letters + string.digits, k=40))}" for _ in range(200)]
    texts += [f"{' '.join(rng.choices(words, k=9))} {''.join(rng.choices(letters, k=24))} {words[3]}" for _ in range(40)]
    found = by_id(op3_secrets.report(op3_secrets.scan(docs_of(spark, texts), labels_of(spark, [(i, 1, 0) for i in range(200)]))), "spans")
    assert sum("markov:" in found[i] for i in range(200, 240)) >= 38
    assert not any("markov:" in found[i] for i in range(200))


def test_long_runs_and_many_matches_take_their_time_once(spark):
    """A long chain of labels, a long run of key characters, many addresses: places equal the regular expressions', in seconds."""
    rng = random.Random(7)
    labels = "mail x@a" + ".b" * 100_000 + " end"
    run = "".join(rng.choices("abcdefABCDEF0123456789_-", k=1_000_000))
    many = " ".join(f"u{i}@ex.org" for i in range(50_000))
    got = by_id(op7_pii.report(op7_pii.scan(docs_of(spark, [labels, many]))), "n_email", "base_sha256")
    begun = time.time()
    assert got[0] == (1, hashlib.sha256(f"email:5:{len(labels) - 4}".encode()).hexdigest())
    assert got[1] == (50_000, hashlib.sha256(personal_base(many).encode()).hexdigest())
    found = by_id(op3_secrets.report(op3_secrets.scan(docs_of(spark, [run, "a token=abcdef123 b"]), labels_of(spark, [(1, 1, 0)]))), "spans")
    assert time.time() - begun < 60 and set(found) == {0, 1}
    begun = time.time()
    clean = by_id(op7_pii.sanitise(docs_of(spark, [many, "x " + labels])), "text")
    assert clean[0] == " ".join(["[email]"] * 50_000) and clean[1] == "x mail [email] end" and time.time() - begun < 60


@pytest.mark.parametrize("make", [odd_docs, empty_docs])
def test_odd_tables(spark, make):
    docs, labels = make(spark), labels_of(spark, [(1, 1, 0), (None, None, None)])
    n = docs.count()
    assert op3_secrets.report(op3_secrets.scan(docs, labels)).count() == n
    assert op7_pii.report(op7_pii.scan(docs)).count() == n
    for out in (op3_secrets.redact(docs, labels), op7_pii.sanitise(docs)):
        assert out.count() == n and out.columns == docs.columns
