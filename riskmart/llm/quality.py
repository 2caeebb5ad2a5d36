"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskmart.llm.labelled import fit, sample
from riskmart.llm.words import Words, mix, pieces, plain, shingles, span_hashes, words

#: Buckets of the hashed n-grams; one more weight is the bias.
BUCKETS = 1 << 18
#: Bound of the training sample, in labelled documents.
MOST_LABELLED = 20_000
PASSES = 3
#: Parameters of the per-coordinate updates: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5

#: Classes of bytes for the shape of a word: a-z, A-Z, 0-9, bytes of longer characters; other ASCII stands for itself.
SHAPES = np.array(
    [97 if 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 200 if b >= 128 else b for b in range(256)], np.uint8
)


def word_shapes(w: Words) -> np.ndarray:
    """Hash of each word's shape: its byte classes with repeats merged, so that `Was`, `The` and `Their` agree."""
    kind = SHAPES[w.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[w.start] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return span_hashes(kind[keep], at[w.start], at[w.end])


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values (a logarithm of the count, of length 1 in each text) of word and shape n-grams, and their pointer.

    Words and pairs of words, shapes and pairs of shapes, and for each neighbouring pair whether both words are equal.
    """
    w = words(texts, lower=False)
    shape = word_shapes(w)
    owner = w.owner()
    runs = [(w.hash, w.ptr), shingles(w.hash, w.ptr, 2), (shape ^ np.uint64(1), w.ptr), shingles(shape, w.ptr, 2)]
    next_to = np.flatnonzero(owner[1:] == owner[:-1])
    same = (w.hash[next_to] == w.hash[next_to + 1]).astype(np.uint64) + np.uint64(17)
    values = np.concatenate([mix(v + np.uint64(k)) & np.uint64(BUCKETS - 1) for k, (v, _) in enumerate(runs)] + [mix(same) & np.uint64(BUCKETS - 1)])
    owners = np.concatenate([np.repeat(np.arange(len(p) - 1), np.diff(p)) for _, p in runs] + [owner[next_to]])
    key = owners.astype(np.int64) * BUCKETS + values.astype(np.int64)
    distinct, count = np.unique(key, return_counts=True)
    own = distinct // BUCKETS
    value = np.log1p(count)
    ptr = np.searchsorted(own, np.arange(len(w.ptr)))
    square = np.concatenate([[0.0], np.cumsum(value * value)])
    norm = np.sqrt(square[ptr[1:]] - square[ptr[:-1]])
    return (distinct % BUCKETS).astype(np.int32), (value / np.where(norm[own] > 0, norm[own], 1)).astype(np.float32), ptr


def _features(part: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    bucket, value, ptr = ngrams(part.column("text"))
    spans = list(zip(ptr[:-1], ptr[1:], strict=True))
    return [bucket[s:e] for s, e in spans], [value[s:e] for s, e in spans]


def train(rows: list[tuple], passes: int = PASSES) -> np.ndarray:
    """Weights after `passes` rounds of single-document updates; without rows all are 0, so every score is 0.5."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        own = z[at]
        w = -(own - np.sign(own) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(own) <= L1] = 0.0
        return w

    for _ in range(passes):
        for _, y, a, b in rows:
            at = np.append(np.frombuffer(a, np.int32), BUCKETS)
            x = np.append(np.frombuffer(b, np.float32), 1.0)
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weight(np.arange(BUCKETS + 1))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> np.ndarray:
    """Weights from at most about `most` documents with a label."""
    return fit(sample(plain(docs, "doc_id", "text"), labels, label, most), _features, train)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score: the logistic function of a sparse dot product, over the whole text.

    NULL and empty texts have no n-grams and score by the bias alone. Rows come out as often as they come in.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            for part in pieces(batch, "text", 1 << 19):
                bucket, value, ptr = ngrams(part.column("text"))
                total = np.concatenate([[0.0], np.cumsum(w[bucket] * value)])
                z = total[ptr[1:]] - total[ptr[:-1]] + w[-1]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))], ["doc_id", "score"])

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")
