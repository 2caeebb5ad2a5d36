"""Toxicity by multiple-instance learning: labels are of documents, scores are of sentences.

A sentence is a bag of hashed words and word beginnings with a logistic score p; a document is toxic unless all its sentences are clean,
so its score is the noisy-or 1 - prod(1 - p). Training follows the gradient of the documents' log loss through the
noisy-or; afterwards the sentence scores say which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.labelled import fit, sample
from riskmart.llm.tables import stored
from riskmart.llm.words import PUNCTUATION, mix, pieces, plain, span_hashes, words

#: Buckets of the hashed words.
BUCKETS = 1 << 20
#: Bound of the training sample, in labelled documents.
MOST_LABELLED = 20_000
EPOCHS = 120
#: Training documents that a term must occur in to be learnt, and by how many standard errors more often in toxic ones.
LEAST, ERRORS = 5, 4.0
#: Beginnings of longer words, in bytes, are terms too: inflected forms of an insult share them.
PREFIXES = (4, 5, 6)
#: Bytes that end a sentence.
ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


def sentences(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Buckets of words and of their beginnings, the pointer of sentences into them, the pointer of texts into sentences, and each sentence's byte span in its text.

    A sentence is a maximal run of words without `.`, `!`, `?` or a line break between them; one without words is none.
    """
    w = words(texts, PUNCTUATION)
    stops = np.flatnonzero(ENDS[w.data])
    owner = w.owner()
    place = np.searchsorted(stops, w.start)
    head = np.ones(len(w.start), bool)
    head[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(head)
    sentence_ptr = np.append(first, len(w.start))
    text_ptr = np.searchsorted(first, w.ptr)
    base = w.text_ptr[owner[first]] if len(first) else first
    start = w.start[first] - base if len(first) else first
    end = w.end[sentence_ptr[1:] - 1] - base if len(first) else first
    size = w.end - w.start
    terms = [(w.hash, np.arange(len(size)))]
    for width in PREFIXES:
        longer = np.flatnonzero(size > width)
        terms.append((mix(span_hashes(w.data, w.start[longer], w.start[longer] + width) + np.uint64(width)), longer))
    at = np.concatenate([t[1] for t in terms])
    order = np.argsort(at, kind="stable")
    bucket = (np.concatenate([t[0] for t in terms]) & np.uint64(BUCKETS - 1)).astype(np.int32)[order]
    return bucket, np.searchsorted(at[order], sentence_ptr), text_ptr, start, end


def sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ptr[1:]] - total[ptr[:-1]]


def logit(weights: np.ndarray, buckets: np.ndarray, sentence_ptr: np.ndarray) -> np.ndarray:
    """Scores of sentences before the logistic function; the last weight is the bias."""
    return sums(weights[buckets], sentence_ptr) + float(weights[-1])


def noisy_or(z: np.ndarray, text_ptr: np.ndarray) -> np.ndarray:
    """1 - prod(1 - sigmoid(z)) per text; 0 for a text without sentences."""
    return np.clip(-np.expm1(-sums(np.logaddexp(0.0, z), text_ptr)), 0.0, 1.0)


def _features(part: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    buckets, sentence_ptr, text_ptr, _, _ = sentences(part.column("text"))
    a, b = [], []
    for k in range(len(text_ptr) - 1):
        own = sentence_ptr[text_ptr[k] : text_ptr[k + 1] + 1]
        a.append(buckets[own[0] : own[-1]] if len(own) > 1 else buckets[:0])
        b.append(np.diff(own).astype(np.int32) if len(own) > 1 else np.zeros(0, np.int32))
    return a, b


def telling(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which terms are learnt, by the documents that hold them and all documents; both first of those not toxic, then of the others."""
    n = np.maximum(n, 1)
    pooled = seen.sum(0) / n.sum()
    error = np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    return (seen.sum(0) >= LEAST) & (seen[1] / n[1] - seen[0] / n[0] > ERRORS * error)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, clean, toxic: how many documents of each kind hold a term."""
    seen = np.zeros((2, BUCKETS), np.int32)
    for batch in batches:
        for y, bag in zip(batch.column("y").to_pylist(), batch.column("a"), strict=True):
            seen[int(y > 0.5), np.unique(np.frombuffer(bag.as_py(), np.int32))] += 1
    used = np.flatnonzero(seen.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (used, seen[0, used], seen[1, used])], ["bucket", "clean", "toxic"])


def _only_telling(made: DataFrame) -> DataFrame:
    """The features (order, y, a, b) with the terms that are learnt alone, so that one task need not hold all the others."""
    made = stored(made)
    kinds = made.agg(F.count(F.when(F.col("y") <= 0.5, 1)), F.count(F.when(F.col("y") > 0.5, 1))).first()
    n = np.array(list(kinds))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.stack([batch.column(c).to_numpy() for c in ("clean", "toxic")])
            yield batch.select(["bucket"]).filter(pa.array(telling(seen, n)))

    counts = made.select("y", "a").mapInArrow(_counted, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    learnt = np.zeros(BUCKETS, bool)
    learnt[[row["bucket"] for row in counts.mapInArrow(choose, "bucket long").collect()]] = True  # BUCKETS rows at most
    shared = made.sparkSession.sparkContext.broadcast(np.packbits(learnt))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            a, b = [], []
            for bag, lengths in zip(batch.column("a"), batch.column("b"), strict=True):
                bag, lengths = (np.frombuffer(x.as_py(), np.int32) for x in (bag, lengths))
                own = wanted[bag]
                ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                a.append(bag[own].tobytes())
                b.append(np.diff(np.concatenate([[0], np.cumsum(own)])[ends]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("y"), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["order", "y", "a", "b"])

    return made.mapInArrow(keep, made.schema)


def train(rows: list[tuple], epochs: int = EPOCHS, rate: float = 0.1, decay: float = 3e-5) -> np.ndarray:
    """Weights by Adam on the mean log loss of all documents.

    Only terms that occur in LEAST training documents, and in toxic ones more often than in others by ERRORS standard
    errors, are learnt; the rest keep weight 0. Without this, words that happen to occur in a few toxic documents would
    explain the labels of the training documents and nothing else.
    """
    weights = np.zeros(BUCKETS + 1)
    weights[-1] = -6.0
    if not rows:
        return weights
    y = np.array([r[1] for r in rows])
    seen = np.zeros((2, BUCKETS), np.int32)
    for _, label, bag, _ in rows:
        seen[int(label > 0.5), np.unique(np.frombuffer(bag, np.int32))] += 1
    learnt = telling(seen, np.array([(y <= 0.5).sum(), (y > 0.5).sum()]))
    bags = [np.frombuffer(r[2], np.int32) for r in rows]
    lengths = [np.frombuffer(r[3], np.int32) for r in rows]
    text_ptr = np.concatenate([[0], np.cumsum([len(x) for x in lengths])])
    ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths, dtype=np.int64))])
    kept = [learnt[bag] for bag in bags]
    sentence_ptr = np.concatenate([[0], np.cumsum(np.concatenate(kept))])[ends]
    used, ids = np.unique(np.concatenate([bag[k] for bag, k in zip(bags, kept, strict=True)]), return_inverse=True)
    counts = np.diff(sentence_ptr)
    docs = np.repeat(np.arange(len(rows)), np.diff(text_ptr))
    w = np.append(np.zeros(len(used)), weights[-1])
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for step in range(1, epochs + 1):
        z = sums(w[ids], sentence_ptr) + w[-1]
        clean = np.exp(-sums(np.logaddexp(0.0, z), text_ptr))
        p = np.clip(1 - clean, 1e-9, 1 - 1e-9)
        slope = ((p - y) / p)[docs] / (1 + np.exp(-np.clip(z, -35, 35)))
        grad = np.append(np.bincount(ids, np.repeat(slope, counts), len(used)) / len(rows) + decay * w[:-1], slope.sum() / len(rows))
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights[used] = w[:-1]
    weights[-1] = w[-1]
    return weights


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> np.ndarray:
    """Weights (BUCKETS and a bias) from at most about `most` documents with a label; without any, every score is near 0."""
    return fit(sample(plain(docs, "doc_id", "text"), labels, label, most), _features, train, _only_telling)


def score(docs: DataFrame, weights: np.ndarray, offending: float = 0.5) -> DataFrame:
    """doc_id, score, n_sentences, n_offending (sentence score at least `offending`), worst_start and worst_end.

    The last two are the byte span of the sentence with the highest score (the first of equals), NULL without sentences.
    NULL and empty texts score 0. Rows come out as often as they come in. Each text is handled by itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for part in pieces(batch, "text", 1 << 19):
                buckets, sentence_ptr, text_ptr, start, end = sentences(part.column("text"))
                z = logit(w, buckets, sentence_ptr)
                n = np.diff(text_ptr)
                hits = np.concatenate([[0], np.cumsum(z >= np.log(offending / (1 - offending)))])
                order = np.lexsort((np.arange(len(z)), -z, np.repeat(np.arange(len(n)), n)))
                worst = order[text_ptr[:-1][n > 0]]
                spans = [np.zeros(len(n), np.int64) for _ in range(2)]
                for span, at in zip(spans, (start, end), strict=True):
                    span[n > 0] = at[worst]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(noisy_or(z, text_ptr)),
                        pa.array(n.astype(np.int64)),
                        pa.array(hits[text_ptr[1:]] - hits[text_ptr[:-1]], pa.int64()),
                        *(pa.array(span, mask=n == 0) for span in spans),
                    ],
                    ["doc_id", "score", "n_sentences", "n_offending", "worst_start", "worst_end"],
                )

    schema = "doc_id long, score double, n_sentences long, n_offending long, worst_start long, worst_end long"
    return plain(docs, "doc_id", "text").mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 19):
                buckets, sentence_ptr, text_ptr, _, _ = sentences(part.column("text"))
                yield part.filter(pa.array(noisy_or(logit(shared.value, buckets, sentence_ptr), text_ptr) < threshold))

    return docs.mapInArrow(run, docs.schema)
