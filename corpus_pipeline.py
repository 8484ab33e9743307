"""From raw documents to token files: rejects, near copies and benchmark text go, the rest is mixed and encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``docs``.
``run`` writes each stage's rows as Parquet into the shared folder and reads them back for the next.

Edge cases are those of the operators called, which each stage states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplecraft import prepare
from samplecraft.llm import decontaminate, jaccard, mix, quality, token_files
from samplecraft.llm.common import materialise
from samplecraft.llm.queries import table, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on the labelled ones among ``docs``."""
    prepare(spark)
    model = quality.train(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    return quality.keep(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by alike shingle sets one stays: five words, similarity 0.8 or more."""
    prepare(spark)
    return jaccard.keep_one(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more lies in benchmark windows go."""
    prepare(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order."""
    prepare(spark)
    return mix.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token shards, and from these a row a document: where it starts, its ids and their checksum.

    Shards follow the order of the table they are read from, which is the training order that the mix wrote. Documents
    that come from no files, and so have no order, go by key.
    """
    prepare(spark)
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*place)
    except AnalysisException:
        place = []
    # Python workers also serve the other stages, so they keep less here, and only the tokenizer beyond a task.
    return token_files.encode_documents(spark, docs, tokenizer_path(), kept_pieces=150_000, order=place, stay=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_copies", near_copies),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: A trained model, components and a tokenizer: no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
