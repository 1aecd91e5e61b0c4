"""The pipeline on planted documents, stage by stage."""

import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from stagecraft.llm import op10_decontaminate, op9_quality
from stagecraft.llm.common import stored

from .util import docs_of, labels_of


def planted(spark, folder: str):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghil", k=rng.randint(2, 8))) for _ in range(300)]
    clean = [" ".join(rng.choices(words, k=rng.randint(60, 120))) for _ in range(80)]
    near = clean[0].split()
    near[5] = "changed"
    item = " ".join(rng.choices(words, k=30))
    texts = [*clean, " ".join(w.upper() + "!!" for w in rng.choices(words, k=60)), clean[1], " ".join(near),
             f"{' '.join(rng.choices(words, k=40))} {item} {' '.join(rng.choices(words, k=40))}",
             f"{' '.join(rng.choices(words, k=40))} token=abcdef0123456789abcdef {' '.join(rng.choices(words, k=40))}"]
    docs_of(spark, texts).write.parquet(f"{folder}/documents.parquet")
    labels_of(spark, [(i, 1, 0) for i in [*range(60), 84]]).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts


def test_stages_take_effect(spark, tmp_path):
    texts = planted(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert name == "tokens" or docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] if "text" in docs.columns else r["n_tokens"] for r in docs.collect()}
    assert set(range(85)) - set(kept["quality"]) == {80}
    assert set(kept["quality"]) - set(kept["near_duplicates"]) == {81, 82}
    assert set(kept["near_duplicates"]) - set(kept["decontaminate"]) == {83}
    assert "token=" not in kept["secrets"][84] and kept["secrets"][3] == texts[3]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert kept["tokens"] == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in kept["secrets"].items()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept["tokens"])


def test_null_and_repeated_ids_are_judged_by_row(spark, tmp_path):
    texts = planted(spark, str(tmp_path))
    rows = [r for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect() if r["doc_id"] < 80]
    junk, passage, secret = texts[80], texts[83], texts[84]
    # Each planted text once without an id and once under the id of a clean text.
    rows += [(i, t, "en", "s", len(t)) for t, id_ in ((junk, 61), (passage, 62), (secret, 63)) for i in (None, id_)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{tmp_path}/documents.parquet").schema)
    stages, kept = dict(corpus_pipeline.STAGES), {}
    for name in ("quality", "decontaminate", "secrets"):
        kept[name] = [(r["doc_id"], r["text"]) for r in stages[name](spark, docs, str(tmp_path)).collect()]
    assert not any(t == junk for _, t in kept["quality"]) and {(None, passage), (61, texts[61])} <= set(kept["quality"])
    assert len(kept["decontaminate"]) == 84 and not any(t == passage for _, t in kept["decontaminate"])
    assert {(None, junk), (62, texts[62])} <= set(kept["decontaminate"])
    assert len(kept["secrets"]) == 86 and not any("token=abc" in (t or "") for _, t in kept["secrets"])
    assert {(63, texts[63]), (None, junk), (None, passage)} <= set(kept["secrets"])


def test_near_duplicates_keep_every_different_text(spark):
    """Rows of one id with different texts, and rows without an id, are judged one by one."""
    rng = random.Random(3)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(40)) for _ in range(4))
    rows = [(1, a), (7, a), (7, b), (9, b), (7, c), (None, c), (None, d), (None, d), (None, None), (5, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, sign string")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(t for _, t in found if t) == sorted([a, b, c, d])
    assert (1, a) in found and (9, b) in found and found.count((5, "")) == 2 and (None, None) in found


class _Captured:
    """Stands for a table: keeps the function that would run in the tasks."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_decontaminate_holds_a_small_slice(monkeypatch):
    rng, given = random.Random(4), []
    words = ["".join(rng.choices("abcdefghil", k=rng.randint(2, 8))) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    step = op10_decontaminate.window_rows(_Captured(), bytes(1 << 20)).run
    monkeypatch.setattr(op10_decontaminate, "give_back", lambda: given.append(True), raising=False)
    tracemalloc.start()
    assert sum(b.num_rows for b in step(iter([batch]))) == 0  # an empty bitmap rules all windows out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6 and given == [True]


def test_quality_model_is_built_by_small_plans(spark, monkeypatch, capsys):
    """The driver holds a plan's shuffles and broadcasts at once: 42 and 11 in one plan before its orders were stored."""
    found = []

    def kept(df, name):
        capsys.readouterr()
        df.explain()
        found.append((len(re.findall(r"\bExchange ", plan := capsys.readouterr().out)), plan.count("BroadcastExchange")))
        return stored(df, name)

    monkeypatch.setattr(op9_quality, "stored", kept)
    counts = spark.createDataFrame([(97 << 42 | 98 << 21 | 97 + i, i + 1) for i in range(9)], "unit long, a long")
    model = op9_quality.log_probabilities(counts.select("unit"), counts)
    kept(model, "test-model")
    assert max(n for n, _ in found) <= 8 and max(n for _, n in found) <= 6
    # Nothing trusted: no model.
    assert op9_quality.log_probabilities(counts.select("unit"), counts.where("a < 0")).count() == 0


def test_bitmap_is_one_job_and_has_every_bit(spark):
    rng = np.random.default_rng(5)
    hashes = np.concatenate([rng.integers(-2**63, 2**63, 3000), [0, -1, 2**63 - 1, -2**63, 63 << 41, 64 << 41]])
    bench = spark.createDataFrame([(int(h),) for h in hashes], "hash long")
    spark.sparkContext.setJobGroup("bitmap", "bitmap")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = op10_decontaminate.bitmap(bench)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("bitmap")
    finally:
        spark.conf.unset(coalesce)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    flags = np.zeros(1 << op10_decontaminate.FILTER_BITS, np.uint8)
    flags[(hashes.view(np.uint64) >> np.uint64(64 - op10_decontaminate.FILTER_BITS)).astype(np.int64)] = 1
    assert got == np.packbits(flags, bitorder="little").tobytes()
    assert len(jobs) <= 3  # one a partition before
    assert op10_decontaminate.bitmap(bench.limit(0)) == bytes(1 << op10_decontaminate.FILTER_BITS - 3)
