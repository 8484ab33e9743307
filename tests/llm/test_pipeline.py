"""The pipeline and the registered queries of the package, over whole small tables."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from samplecraft.llm import jaccard, mix
from samplecraft.llm.common import materialise
from samplecraft.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    import __spark_entry__

    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def test_stages(spark, docs, tmp_path):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    kept = stages["near_copies"](spark, docs, SF)
    assert kept.schema == docs.schema
    want = {w[2] if w[1] else w[0] for w in brute.jaccard(pairs, 5, 80)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    clean = stages["benchmark_decontamination"](spark, docs, SF)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(w[0] for w in brute.decontaminate(pairs, items) if not w[5])
    good = stages["quality_classifier"](spark, docs, SF)
    assert good.schema == docs.schema and 0 < good.count() < docs.count()


def test_run(spark, docs):
    first = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1])
    ends = 0
    for _, start, n, _ in first:
        assert start == ends
        ends += n
    ids = [r[0] for r in first]
    assert ids != sorted(ids) and 1 < max(ids.count(i) for i in set(ids)) <= 3
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1]) == first


def test_shards_follow_the_training_order(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    mixed = materialise(stages["source_mix"](spark, docs, SF))
    placed = mix.assign(docs).select("doc_id", F.posexplode("positions").alias("copy", "position"))
    want = [r["doc_id"] for r in placed.orderBy("position", "doc_id").collect()]
    got = [r["doc_id"] for r in stages["token_output"](spark, mixed, SF).orderBy("start").collect()]
    assert got == want
    # without files there is no order but the key's
    loose = stages["token_output"](spark, spark.createDataFrame(docs.limit(50).collect(), docs.schema), SF)
    keys = [r["doc_id"] for r in loose.orderBy("start").collect()]
    assert keys == sorted(keys) and len(keys) == 50


def test_empty_tables(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).isEmpty(), name


def test_queries_against_brute_force(spark, docs):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {n: [tuple(r) for r in QUERIES[n](spark, SF).collect()] for n in ("op5_jaccard", "op6_suffix_dedup", "op10_secrets")}
    assert sorted(got["op5_jaccard"]) == sorted(brute.jaccard(pairs))
    assert sorted(got["op6_suffix_dedup"]) == sorted(brute.suffixes(pairs))
    assert sorted(r[:5] for r in got["op10_secrets"]) == sorted(brute.secrets(pairs))
    assert jaccard.PERCENT == 85 and jaccard.SIZE == 4
