"""Words, their hashes and shingles of whole texts, computed over the byte buffers of Arrow batches.

Words are the runs of bytes outside a separator set; A-Z count as a-z. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes hashed at once; bounds the temporary arrays whatever the length of a text.
CHUNK = 1 << 20
#: Longer words get a hash of their own: sums of powers modulo 2^64 are equal for some pairs of different long words.
LONG = 64
#: Fixed odd multipliers of the hashes.
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93

#: Space and \x09-\x0D.
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
#: Every ASCII byte but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A-Z to a-z, all else unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> list[np.ndarray]:
    if not _powers:
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            row = np.full(CHUNK, base, np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end]; spans are not empty, do not overlap and ascend."""
    out = np.empty(len(starts), np.uint64)
    power, inverse = _tables()
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = int(np.searchsorted(ends, low + CHUNK, "right"))
        if j <= i:  # one span longer than a chunk
            out[i] = xxhash.xxh64_intdigest(data[low : int(ends[i])].tobytes())
            i += 1
            continue
        n = int(ends[j - 1]) - low
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data[low : low + n].astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[e] - total[s]) * inverse[s])
        for k in np.flatnonzero(e - s > LONG) + i:
            out[k] = xxhash.xxh64_intdigest(data[int(starts[k]) : int(ends[k])].tobytes())
        i = j
    return out


@dataclass
class Words:
    """Words of a batch of texts: text k owns words ptr[k] to ptr[k + 1]; start and end are offsets into data."""

    data: np.ndarray
    text_ptr: np.ndarray
    ptr: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts and the offsets of each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ptr = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ptr[0] : ptr[-1]], ptr - ptr[0]


def words(texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = True) -> Words:
    """The words of each text."""
    data, text_ptr = buffers(texts)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = text_ptr[:-1][np.diff(text_ptr) > 0]
    first[heads] = inside[heads]  # a word never crosses texts
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = heads[1:] - 1 if len(heads) else heads
    last[tails] = inside[tails]
    end = np.flatnonzero(last) + 1
    return Words(data, text_ptr, np.searchsorted(start, text_ptr), start, end, span_hashes(data, start, end))


def shingles(hashes: np.ndarray, ptr: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `width` words of each text, and their pointer; a shorter text that has words gives one, of all of them."""
    n = np.diff(ptr)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_ptr = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(ptr[:-1] - out_ptr[:-1], count) + np.arange(out_ptr[-1])
    size = np.repeat(np.minimum(n, width), count)
    value = size.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            whole = size > k
            if whole.all():
                value = value * np.uint64(STEP) + hashes[at + k] if len(at) else value
            else:
                value[whole] = value[whole] * np.uint64(STEP) + hashes[at[whole] + k]
    return mix(value), out_ptr


def pieces(batch: pa.RecordBatch, column: str, most: int = CHUNK, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows so that the column's texts stay near `most` bytes and `rows` rows; a longer text comes alone."""
    if not batch.num_rows:
        return
    _, ptr = buffers(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = min(i + rows, max(i + 1, int(np.searchsorted(ptr, ptr[i] + most, "right")) - 1))
        yield batch.slice(i, j - i)
        i = j


#: Bits of a shingle in a set; the others hold the number of the text while a piece is sorted.
SET_BITS = 54


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles (54-bit hashes, ascending) and the pointer of the texts; for pieces of 1,024 texts at most."""
    w = words(texts)
    value, ptr = shingles(w.hash, w.ptr, width)
    owner = np.repeat(np.arange(len(ptr) - 1, dtype=np.uint64), np.diff(ptr))
    key = np.sort((owner << np.uint64(SET_BITS)) | (value >> np.uint64(64 - SET_BITS)))
    keep = np.ones(len(key), bool)
    keep[1:] = key[1:] != key[:-1]
    key = key[keep]
    n = np.bincount((key >> np.uint64(SET_BITS)).astype(np.int64), minlength=len(ptr) - 1)
    return key & np.uint64((1 << SET_BITS) - 1), np.concatenate([[0], np.cumsum(n)])


def plain(docs: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, as doc_id (long), text (string) and so on; other columns cannot clash with what an operator adds."""
    kinds = {"doc_id": "long", "text": "string", "source": "string"}
    return docs.select(*(F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in columns))


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Stands for a NULL doc_id, which comes before all others.
NO_ID = -(1 << 63)


def numbered(docs: DataFrame) -> DataFrame:
    """key, copy, text: rows that repeat an id are numbered by text; an id alone is number 0."""
    rows = plain(docs, "doc_id", "text").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    repeated = rows.groupBy("key").count().filter("count > 1").limit(1).count()
    if not repeated:
        return rows.select("key", F.lit(0).alias("copy"), "text")
    return rows.select("key", F.row_number().over(Window.partitionBy("key").orderBy("text")).alias("copy"), "text")
