"""A bounded sample of labelled rows, and training on it in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text, y of about `most` labelled documents at most: a document stays if its hash falls below most / all.

    Rows without text, label or id are left out; a document with several labels takes the largest.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("double").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    n = marks.count()
    share = min(1.0, most / n) if n else 0.0
    kept = marks.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.filter(F.col("text").isNotNull()).join(kept, "doc_id")


def fit(
    rows: DataFrame,
    featurise: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]],
    train: Callable[[list[tuple[np.ndarray, ...]]], np.ndarray],
    narrow: Callable[[DataFrame], DataFrame] = lambda made: made,
) -> np.ndarray:
    """Turn the sample (doc_id, text, y) into features on the executors, then train in one task; the weights come back.

    narrow takes from the features (order, y, a, b) what training does not use. Rows are put in order of a hash of their
    content before training, so a rerun gives the same weights.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from riskmart.llm.words import pieces

        for batch in batches:
            for part in pieces(batch, "text"):
                key = part.column("order").to_numpy()
                columns = featurise(part)
                blobs = [pa.array([b.tobytes() for b in c], pa.binary()) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(key), part.column("y"), *blobs], ["order", "y", "a", "b"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("order", "y", "a", "b")), strict=True)]
        rows.sort()
        yield pa.RecordBatch.from_arrays([pa.array([train(rows).astype(np.float32).tobytes()], pa.binary())], ["weights"])

    keyed = rows.withColumn("order", F.xxhash64("text", "doc_id"))
    made = keyed.select("order", "y", "text").mapInArrow(features, "order long, y double, a binary, b binary")
    got = narrow(made).repartition(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(got[0][0], np.float32)
