"""The tables of the near-copy join, and token shards, have few files where their rows are few, however many partitions a shuffle has."""

from pathlib import Path

from samplecraft.llm import common, jaccard, token_files
from samplecraft.llm.common import tasks_for
from samplecraft.llm.queries import tokenizer_path


def test_tasks_follow_rows(spark):
    least = 2 * spark.sparkContext.defaultParallelism
    assert [tasks_for(spark, n, 10) for n in (0, 10 * least, 10 * least + 1, 10_000_000)] == [least, least, least + 1, 1_000_000]


def test_near_copies_write_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext.__class__, "defaultParallelism", 2)
    folders = (f"{tmp_path}/llm-{k}" for k in range(1000))
    monkeypatch.setattr(common, "shared_folder", lambda _: next(folders))
    words = [[f"w{k}x{i}" for i in range(60)] for k in range(60)]
    rows = [(k, " ".join(w)) for k, w in enumerate(words)] + [(100 + k, " ".join(w[:-1])) for k, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        kept = jaccard.keep_one(docs, size=5, percent=80)
        assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
        assert kept.rdd.getNumPartitions() <= 4
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = [len(list(p.glob("part-*"))) for p in Path(tmp_path).glob("llm-*")]
    assert len(files) >= 10 and max(files) <= 4


def test_files_hold_shards_of_several_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext.__class__, "defaultParallelism", 1)
    monkeypatch.setattr(common, "shared_folder", lambda _: f"{tmp_path}/llm")
    docs = spark.createDataFrame([(k, f"text {k}" * (k % 9)) for k in range(300)], "doc_id long, text string").repartition(2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = sorted(tuple(r) for r in token_files.encode_documents(spark, docs, tokenizer_path()).collect())
        shards = spark.read.parquet(f"{tmp_path}/llm")
        assert len(list(tmp_path.glob("llm/part-*"))) <= 2 < shards.select("part").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r[0] for r in found] == list(range(300))
    assert [r[1] for r in found] == [sum(r[2] for r in found[:k]) for k in range(300)]
