"""Small tables are written to few files, however many partitions a shuffle has."""

from pathlib import Path

from samplecraft.llm import common, simhash
from samplecraft.llm.common import FILE_ROWS, files_for, materialise


def test_files_follow_rows(spark):
    assert [files_for(n) for n in (0, 1, FILE_ROWS, FILE_ROWS + 1)] == [1, 1, 1, 2]
    out = materialise(spark.range(0, 50, 1, 7), files=2)
    assert len(out.inputFiles()) == 2 and out.count() == 50


def test_component_steps_write_few_files(spark, tmp_path, monkeypatch):
    """Chains of texts that differ in a word: several steps, each of one file."""
    words = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join(words[:k] + ["x"] + words[k + 1 :])) for k in range(60)] + [(100 + k, f"other {k} text") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    folders = (f"{tmp_path}/llm-{k}" for k in range(1000))
    monkeypatch.setattr(common, "shared_folder", lambda _: next(folders))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = {r.doc_id: r.component_id for r in simhash.classes(docs).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(found) == 80
    files = sorted(len(list(p.glob("part-*"))) for p in Path(tmp_path).glob("llm-*"))
    assert len(files) >= 5 and files[:-1] == [1] * (len(files) - 1) and files[-1] <= 2
