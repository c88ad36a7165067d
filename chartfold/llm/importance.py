"""Importance resampling towards a target corpus: hashed word features, bucket gains, Gumbel noise, exact top share.

A document's features are its runs of 1 to ``ngrams`` consecutive words; each falls into one of ``buckets`` by its crc32.
The counts of all documents and of all target texts give every bucket a gain, the scaled and floored log ratio of its smoothed shares.
An array of gains scores all features of a block of texts at once.  The drawn rows are the highest of weight + Gumbel noise of
the id; their ranks come from the distributed radix sort (``radix_sort``), so no task and no driver holds an order of all rows.

Null text has no words; null and empty texts, and those with fewer than ``least_words`` words, are never drawn but are in the result.  A row
without doc_id has no noise: its score and rank are null and it is not among the rows the share is taken of.  Repeated rows are rows like others.
Ties of the score go to the smaller doc_id; rows with both equal are ranked one after the other, by a row number of the scored table.  Very
long texts are scored whole.  An empty table gives an empty result, empty targets leave every gain to the smoothing.  Further columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import binary_parts, row_chunks
from .radix_sort import digits_of, radix_sort

BUCKETS = 10_000
NGRAMS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
TEXT_AT_ONCE = 1 << 20

def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc32_spans(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of every span of bytes, byte by byte for all spans that are long enough."""
    order = np.argsort(-lengths, kind="stable")
    at, n = starts[order], lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    counts = np.bincount(n, minlength=1)[::-1].cumsum()[::-1] if len(n) else np.zeros(1, np.int64)   # spans of at least k bytes
    for k in range(int(n[0]) if len(n) else 0):
        live = int(counts[k + 1])
        c = crc[:live]
        crc[:live] = _CRC[(c ^ raw[at[:live] + k]) & 0xFF] ^ (c >> 8)
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    return out


_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def feature_buckets(data: np.ndarray, off: np.ndarray, buckets: int, ngrams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, text of each feature, words of each text) for the texts between the offsets."""
    raw = _LOWER[data[int(off[0]):int(off[-1])]]
    off = (off - off[0]).astype(np.int64)
    size = len(raw)
    inside = _WORD[raw]
    edge = np.zeros(size + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:size]
    last[:-1] &= ~inside[1:] | edge[1:size]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(off, starts, side="right") - 1
    words = np.bincount(text, minlength=len(off) - 1)
    if ngrams == 1:
        return (crc32_spans(raw, starts, ends - starts) % np.uint32(buckets)).astype(np.int64), text, words
    # longer runs: words written one after the other with one space between, so a run of words is a span
    n = ends - starts
    to = np.concatenate(([0], np.cumsum(n + 1)))
    line = np.full(int(to[-1]), 0x20, np.uint8)
    line[np.repeat(to[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))] = raw[inside]
    found, owner = [], []
    for k in range(1, ngrams + 1):
        i = np.arange(len(n) - k + 1) if len(n) >= k else np.zeros(0, np.int64)
        i = i[text[i] == text[i + k - 1]]
        found.append(crc32_spans(line, to[i], to[i + k - 1] + n[i + k - 1] - to[i]) % np.uint32(buckets))
        owner.append(text[i])
    return np.concatenate(found).astype(np.int64), np.concatenate(owner), words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, ngrams: int = NGRAMS) -> np.ndarray:
    """Features in each bucket over all rows of the first column; a task adds up its texts, the driver reads one count a bucket."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            off, data = binary_parts(batch.column(0))
            for lo, hi in row_chunks(off, TEXT_AT_ONCE):
                total += np.bincount(feature_buckets(data, off[lo:hi + 1], buckets, ngrams)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])
    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of (target share / source share)) of every bucket, one added to each count."""
    m, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + m) / ((float(s) + 1) * (t_all + m)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, ngrams: int = NGRAMS) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of every row."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            off, data = binary_parts(batch.column("text"))
            n_features, n_words, weight = (np.zeros(len(off) - 1, np.int64) for _ in range(3))
            for lo, hi in row_chunks(off, TEXT_AT_ONCE):
                bucket, text, words = feature_buckets(data, off[lo:hi + 1], buckets, ngrams)
                n_words[lo:hi] = words
                n_features[lo:hi] = np.bincount(text, minlength=hi - lo)
                np.add.at(weight[lo:hi], text, gain[bucket])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_features), pa.array(n_words), pa.array(weight)],
                                             names=["doc_id", "n_features", "n_words", "weight"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


def gumbel(doc_id, seed: int):
    """Scaled and floored Gumbel noise of an id: fixed by the seed and the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, ngrams: int = NGRAMS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``target``: texts in its column ``text``."""
    spark = docs.sparkSession
    texts = [d.select(F.col("text").cast("string").alias("text")) for d in (docs, target)]
    gain = gains(*(bucket_counts(t, buckets, ngrams) for t in texts))
    path = scratch_path(spark, "importance")
    (weigh(docs, gain, ngrams).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
     .withColumn("row", F.monotonically_increasing_id()).write.parquet(path))
    scored = spark.read.parquet(path)
    fits = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    n, high, low, first_id, last_id = scored.where(fits).agg(F.count(F.lit(1)), F.max("score"), F.min("score"), F.min("doc_id"), F.max("doc_id")).first()
    rest = scored.where(~fits)
    columns = ["doc_id", "n_features", "weight", "score"]
    out = rest.select(*columns, F.lit(None).cast("long").alias("rank"))
    if not n:
        return out
    key = [(F.lit(high) - F.col("score"), (high - low).bit_length()), (F.col("doc_id") - F.lit(first_id), (last_id - first_id).bit_length())]
    ranked = radix_sort(scored.where(fits).select(*columns, "row"), digits_of(key), n, F.col("row"))
    rank = F.when(F.col("place") < percent * n // 100, F.col("place") + 1)
    return ranked.select(*columns, rank.cast("long").alias("rank")).unionByName(out)
