"""How much of a table a task holds at once on its way through Python."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lodgecurve.llm import mixing
from lodgecurve.llm.common import BATCH_BYTES, short_batches


def test_features_of_a_batch_are_held_in_parts():
    class Watched(mixing.Classifier):
        largest = 0

        def posteriors(self, x: np.ndarray) -> np.ndarray:
            self.largest = max(self.largest, len(x))
            return super().posteriors(x)

    width = 257 + mixing.HASHED
    model = Watched(["a", "b"], np.zeros(width), np.ones(width), np.zeros((width, 2)))
    ids = list(range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array([f"word {i}".encode() for i in ids])], ["uid", "id", "body"])
    found = pa.Table.from_batches(mixing.measured(iter([batch]), model))
    assert model.largest <= 1024
    assert found["uid"].to_pylist() == found["id"].to_pylist() == ids
    assert set(found["tokens"].to_pylist()) == {2} and all(p == [0.5, 0.5] for p in found["p"].to_pylist())


def test_texts_travel_in_short_batches(spark):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    def largest() -> int:
        docs = spark.range(0, 12_000, 1, 1).selectExpr("id", "repeat('x', 1000) AS body")
        return max(r.size for r in docs.mapInArrow(sizes, "size long").collect())

    before = spark.conf.get(BATCH_BYTES, None)
    try:
        spark.conf.unset(BATCH_BYTES)
        short_batches(spark)
        assert largest() < 3 << 20
        spark.conf.set(BATCH_BYTES, str(8 << 20))  # a session's own limit stays
        short_batches(spark)
        assert largest() > 6 << 20
    finally:
        spark.conf.set(BATCH_BYTES, before) if before else spark.conf.unset(BATCH_BYTES)
