"""Bad files of a load are found by one probe that reads each file alone."""

import bz2
import gzip
import os

import pytest

from stagecraft.session import work_dir
from stagecraft.sources import loader
from stagecraft.sources.loader import LoadTemplate, load_files, read_target, unreadable_files
from stagecraft.sources.probe import MISSING, can_probe, failing_files

TEMPLATE = LoadTemplate("T", "T", "a int, b string", "csv", {})


def _put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_many_bad_files_take_one_probe(spark, monkeypatch):
    d = work_dir(spark, "probe")
    whole = gzip.compress(b"1,x\n2,y\n" * 400)
    paths, bad = [], set()
    for i in range(240):
        kind = i % 8
        if kind == 0:
            bad.add(_put(f"{d}/cut [{i}].csv.gz", whole[:len(whole) // 2]))
            paths.append(f"{d}/cut [{i}].csv.gz")
        elif kind == 1:
            bad.add(f"{d}/gone {i}.csv")
            paths.append(f"{d}/gone {i}.csv")
        elif kind == 2:
            paths.append(_put(f"{d}/ok{i}.csv.gz", whole))
        else:
            paths.append(_put(f"{d}/ok%41{i}.csv", b"1,x\n"))
    reads, parse = [], loader.parse_staged
    monkeypatch.setattr(loader, "parse_staged", lambda *a: reads.append(1) or parse(*a))
    monkeypatch.setattr(loader, "_halved", lambda *a: pytest.fail("no halving where the probe can judge"))
    hist = {r.file_name: r for r in load_files(spark, paths, TEMPLATE, f"{d}/t", "l").collect()}
    assert len(reads) == 2  # the load that failed, and the one without the bad files
    assert {p for p, r in hist.items() if r.status == "LOAD_FAILED"} == bad and len(hist) == len(paths)
    assert all(hist[p].first_error_message == MISSING for p in bad if "gone" in p)
    assert all("end-of-stream" in hist[p].first_error_message for p in bad if "cut" in p)
    assert read_target(spark, f"{d}/t", TEMPLATE.schema_ddl).count() == 30 * 800 + 150


def test_settings_do_not_hide_bad_files(spark):
    d = work_dir(spark, "probe")
    whole = gzip.compress(b"1,x\n" * 4000)
    cut, good = _put(f"{d}/cut.csv.gz", whole[:len(whole) // 2]), _put(f"{d}/good.csv", b"1,x\n")
    names = ("spark.sql.files.ignoreCorruptFiles", "spark.sql.files.ignoreMissingFiles")
    for n in names:
        spark.conf.set(n, "true")
    try:
        hist = {r.file_name: r.status for r in load_files(spark, [cut, good, f"{d}/gone.csv"], TEMPLATE, f"{d}/t", "l").collect()}
    finally:
        for n in names:
            spark.conf.unset(n)
    assert hist == {cut: "LOAD_FAILED", good: "LOADED", f"{d}/gone.csv": "LOAD_FAILED"}


def test_codecs_and_formats(spark):
    d = work_dir(spark, "probe")
    packed = bz2.compress(os.urandom(50_000))
    bad = [_put(f"{d}/x.json.bz2", packed[:20_000]), _put(f"{d}/x.csv.gz", b"no gzip"), f"file:{d}/gone.csv", f"file://{d}/gone2.csv"]
    good = [_put(f"{d}/y.json.bz2", packed), _put(f"{d}/y.csv.gz", b""), _put(f"{d}/empty.csv", b""), _put(f"{d}/two.csv.gz", gzip.compress(b"a") * 2)]
    assert {r["path"] for r in failing_files(spark, bad + good, "csv").collect()} == set(bad)
    assert failing_files(spark, [], "csv").collect() == []
    spark.range(5).coalesce(1).write.parquet(f"{d}/p")
    part = next(f"{d}/p/{f}" for f in os.listdir(f"{d}/p") if f.endswith(".parquet"))
    with open(part, "rb") as f:
        cut = _put(f"{d}/cut.parquet", f.read()[:-10])
    assert [r["path"] for r in failing_files(spark, [part, cut], "parquet").collect()] == [cut]
    assert not can_probe("check:/x/y.csv", "csv") and not can_probe("/x.csv.zst", "csv") and not can_probe("/x.orc", "orc")


def test_halving_finds_what_the_probe_cannot_judge(spark):
    d = work_dir(spark, "probe")
    good, odd = _put(f"{d}/a.csv", b"1,x\n"), _put(f"{d}/b.csv.deflate", b"no codec stream at all")
    found = unreadable_files(spark, [good, odd], TEMPLATE)
    assert list(found) == [odd] and found[odd]
    assert unreadable_files(spark, [good, f"{d}/gone.csv.zst"], TEMPLATE) == {f"{d}/gone.csv.zst": MISSING}
