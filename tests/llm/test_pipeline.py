import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from telemetry_engine.llm import common as C
from telemetry_engine.llm import packing, queries
from telemetry_engine.sources import fs


@pytest.fixture()
def sf_dir(spark, words, tmp):
    """A corpus in which every stage has something to do."""
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(240):
        w = words(rng.randint(30, 120), k).split()
        if k % 4 == 0:
            w.insert(5, "grobnik")
        rows.append((k, " ".join(w), "en", "src0", 0))
        labels.append((k, 1, int(k % 4 == 0)))
    clean = words(150, 5000)
    rows += [(1000, clean, "en", "s", 0), (1001, clean, "en", "s", 0), (1002, clean + " more", "en", "s", 0)]
    rows += [(1010, words(60, 1) + " " + words(30, 9000), "en", "s", 0), (1020, "mail a@b.cd " + words(40, 7000), "en", "s", 0)]
    rows += [(1030, None, None, None, None), (1031, "", None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, words(30, 9000))], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return tmp


def test_stages_decide_what_they_should(spark, sf_dir, tmp):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp}/out{k}")
        docs = spark.read.parquet(f"{tmp}/out{k}")
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            assert ids - kept == {i for i in range(0, 240, 4)}
        elif name == "near_copies":
            assert ids - kept == {1001, 1002}
        elif name == "decontamination":
            assert ids - kept == {1010}
        elif name == "pii":
            assert kept == ids
            row = docs.where("doc_id = 1020").first()
            assert row["text"].startswith("mail [EMAIL] ") and row["n_chars"] == len(row["text"])
        else:
            assert kept == ids and docs.groupBy("sequence_id").agg({"length": "sum"}).agg({"sum(length)": "max"}).first()[0] <= 2048
        if name != "packing":
            assert docs.columns == columns
        ids = kept
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_copies", "decontamination", "pii", "packing"]


def test_run_applies_the_stages(spark, sf_dir):
    got = P.run(spark, sf_dir)
    assert got.columns == [*[c.split()[0] for c in packing.SCHEMA.split(", ")], "ids_crc32"]
    ids = {r["doc_id"] for r in got.collect()}
    assert ids == ({k for k in range(240) if k % 4} | {1000, 1020, 1030, 1031})


def test_run_on_repeated_rows_and_clashing_columns(spark, sf_dir, tmp):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.where("doc_id in (1, 4, 1020, 1030)")
    clash = [F.lit(k).alias(c) for k, c in enumerate(["score", "row", "base", "cls", "rid", "pii_text", "a.b", "sequence_id", "ids"])]
    out = f"{tmp}/again"
    docs.unionByName(more).select("*", *clash).write.parquet(f"{out}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    got = P.run(spark, out)
    rows = Counter(r["doc_id"] for r in got.where("start = 0").collect())
    assert set(rows) == {k for k in range(240) if k % 4} | {1000, 1020, 1030, 1031}
    assert rows[1] == rows[1020] == 1 and 4 not in rows


def test_run_on_empty_documents(spark, sf_dir, tmp):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp}/none/{t}.parquet")
    assert P.run(spark, f"{tmp}/none").collect() == []


def test_old_work_folders_go(spark, monkeypatch):
    path = C.store(spark.range(3).toDF("a"), C.work_dir(spark, "aged")).inputFiles()[0].rsplit("/", 1)[0]
    C.work_dir(spark, "next")
    assert fs.exists(spark, path)
    monkeypatch.setattr(C.fs, "older_than", lambda s, base, hours: [path, f"{base}/kept"] if hours == C.WORK_HOURS else [])
    C.work_dir(spark, "next")
    assert not fs.exists(spark, path)


def test_every_operator_has_one_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)
