"""What executors hold beside their heap's live rows: batches of the reader, arrays of a slice, workers between tasks."""

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from lotline import session
from lotline.llm import near_dedup
from lotline.llm.common import released


class Taken:
    """Stands for a table; keeps the function that its operator gives to mapInArrow."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        self.run = run
        return self


@pytest.mark.parametrize("operator", [near_dedup.signatures, near_dedup.multisets])
def test_a_batch_of_many_words_takes_bounded_memory(spark, operator):
    """A batch of 8 MB of text is about 1.2 million words; what a slice of it needs doesn't depend on that."""
    rng, docs, length = np.random.default_rng(1), 3_000, 400
    words = pa.ListArray.from_arrays(pa.array(np.arange(docs + 1, dtype=np.int32) * length), pa.array(rng.integers(-(2**63), 2**63 - 1, docs * length)))
    ids = pa.array(np.arange(docs))
    cols = {"uid": ids, "doc_id": ids, "w": words} if operator is near_dedup.signatures else {"uid": ids, "w": words}
    run = operator(Taken()).run
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in run(iter([pa.RecordBatch.from_pydict(cols)])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == docs
    assert peak < 24 << 20


def resident() -> int:
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) << 10


def test_a_worker_gives_its_memory_back():
    pin = []

    def run(batches):
        held = [bytearray(b"x") * 100_000 for _ in range(2_000)]
        pin.append([bytearray(b"x") * 1_000 for _ in range(100)])  # what lies above keeps the heap from shrinking by itself
        yield from batches
        del held

    f = released(run)
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    before, out = resident(), f(iter([batch]))
    assert next(out) is batch
    assert resident() - before > 150 << 20
    assert list(out) == []
    assert resident() - before < 50 << 20


def test_the_reader_holds_few_documents(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        session.prepare(spark)
        assert int(spark.conf.get(key)) <= 512
    finally:
        spark.conf.set(key, before)
