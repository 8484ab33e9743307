"""What a Python worker holds after a task does not grow with the number of tasks it has run."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from samplecraft.llm import common, token_files
from samplecraft.llm.queries import tokenizer_path


class Docs:
    """Stands for the documents: the function that tasks run comes back in place of a plan."""

    def mapInArrow(self, run, schema):  # noqa: N802
        return run

    def __getattr__(self, name):
        return lambda *a: self


@pytest.mark.parametrize("stay", [False, True])
def test_tasks_of_a_worker_share_a_tokenizer(spark, monkeypatch, stay):
    import tokenizers

    made, real = Counter(), tokenizers.Tokenizer

    class Counted:
        @staticmethod
        def from_file(path):
            made[path] += 1
            return real.from_file(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    token_files.encoder.cache_clear()
    run = token_files.write_shards(Docs(), tokenizer_path(), b"", kept_pieces=1000, stay=stay)
    texts = ["one two, three", None, "four  five"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, None], pa.int64()), pa.array(texts), pa.array([7] * 3, pa.int32())], names=["key", "text", "part"])
    found = [[r for b in run(iter([batch])) for r in b.to_pylist()] for _ in range(3)]
    kept = token_files.encoder(tokenizer_path(), token_files.END_ID, 1000)
    token_files.encoder.cache_clear()
    assert list(made.values()) == [1]
    assert bool(kept.known) == stay
    assert found[0] == found[1] == found[2] and len(found[0]) == 1
    reader = token_files.ShardReader(memoryview(found[0][0]["data"]), b"")
    whole = real.from_file(tokenizer_path())
    assert [reader.key(k) for k in range(3)] == [1, 2, None]
    assert [reader.ids(k).tolist() for k in range(3)] == [[*whole.encode(t or "", add_special_tokens=False).ids, token_files.END_ID] for t in texts]


def test_powers_go_with_the_task():
    data = np.frombuffer(b"some words here", np.uint8)
    hashes = common.span_hashes(data, np.array([0, 5]), np.array([4, 10])).tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(["some words here"])], names=["text"])
    assert len(list(common.slices(iter([batch]), "text"))) == 1
    assert not common._POWERS
    assert common.span_hashes(data, np.array([0, 5]), np.array([4, 10])).tolist() == hashes
