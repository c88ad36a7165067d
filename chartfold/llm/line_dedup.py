"""Line deduplication with two Bloom filters.

Map tasks hash every line key once per document and send only bit positions, by segment of the filter.
Each segment task sets the bits of the once-seen filter and those of the twice-seen filter: a position that comes
from two documents.  The twice filter has no false negatives, so only lines whose bits are all
set in it are suspects.  Suspects alone are shuffled, with the key itself, for exact confirmation and
the choice of the first document; a wrong suspicion costs a row there and nothing else.

The filter has a fixed number of bits (a parameter, 32 MB at most with the default bound), so its broadcast is
bounded; with more lines than it is sized for, more lines become suspects and the result is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_array, durable

STRIP = b" \t\n\r\x0b\x0c"
MIN_CHARS = 10
LOG_BITS_LEAST, LOG_BITS_MOST, BITS_PER_LINE = 20, 28, 16
SEGMENTS = 64
PROBES = 2
HELD = 1 << 20     # positions that a map task holds before it sends them


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "surrogatepass"))


def line_keys(text: str | None, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines whose key is long enough."""
    out = []
    for i, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
        key = line.strip(STRIP).lower()
        if len(key) >= min_chars and _code_points(key) >= min_chars:
            out.append((i, key))
    return out


def _probes(hashes: np.ndarray, log_bits: int) -> np.ndarray:
    """Bit positions, one row for each probe; all probes of a hash lie in one segment."""
    per = np.uint64(log_bits - 6)
    segment = hashes >> np.uint64(58)
    rows = [(hashes >> np.uint64(29 * k)) & np.uint64((1 << (log_bits - 6)) - 1) for k in range(PROBES)]
    return np.stack([(segment << per) | r for r in rows]).astype(np.int64)


def _positions(min_chars: int, log_bits: int):
    per = log_bits - 6

    def flush(hashes: np.ndarray):
        # in-task combine: a hash seen twice here is sent once, marked
        value, counts = np.unique(hashes, return_counts=True)
        at = _probes(value, log_bits)
        segment = at[0] >> per
        cuts = np.searchsorted(segment, np.arange(SEGMENTS + 1))  # value is sorted, so segments are runs
        low = (at & ((1 << per) - 1)).astype("<u4")
        rows = [(s, np.unique(low[:, a:b]).tobytes(), np.unique(low[:, a:b][:, counts[a:b] > 1]).tobytes())
                for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), binary_array([r[1] for r in rows]),
                                           binary_array([r[2] for r in rows])], names=["segment", "once", "twice"])

    def run(batches):
        held = []
        for batch in batches:
            for text in batch.column("text"):
                held.extend({xxhash.xxh3_64_intdigest(k) for _, k in line_keys(text.as_py(), min_chars)})
                if len(held) >= HELD:
                    yield flush(np.array(held, np.uint64))
                    held = []
        if held:
            yield flush(np.array(held, np.uint64))
    return run


def _segment_filter(log_bits: int):
    size = 1 << (log_bits - 6)

    def run(key, parts):
        seen, twice = np.zeros(size, bool), np.zeros(size, bool)
        for once, more in zip(parts.column("once").to_pylist(), parts.column("twice").to_pylist()):
            at = np.frombuffer(once, "<u4")
            twice[at[seen[at]]] = True
            seen[at] = True
            twice[np.frombuffer(more, "<u4")] = True
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": binary_array([np.packbits(twice).tobytes()])})
    return run


def _suspects(min_chars: int, log_bits: int, bits):
    def run(batches):
        filt = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            ids, rows, texts = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text")
            out = ([], [], [], [])
            for doc, row, text in zip(ids, rows, texts):
                keys = line_keys(text.as_py(), min_chars)
                if not keys:
                    continue
                at = _probes(np.array([xxhash.xxh3_64_intdigest(k) for _, k in keys], np.uint64), log_bits)
                hit = ((filt[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
                for j in np.flatnonzero(hit).tolist():
                    out[0].append(doc)
                    out[1].append(keys[j][0])
                    out[2].append(keys[j][1])
                    out[3].append(row)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[1], pa.int32()), binary_array(out[2])],
                                             names=["doc_id", "text_key", "line", "key"])
    return run


def filter_bits(n_lines: int) -> int:
    """Logarithm of the filter's bits for so many lines."""
    return min(LOG_BITS_MOST, max(LOG_BITS_LEAST, (max(1, n_lines) * BITS_PER_LINE - 1).bit_length()))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_key, drop: array of line numbers) of the rows (doc_id, text, text_key) that lose lines."""
    spark = docs.sparkSession
    n_lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    log_bits = filter_bits(n_lines)
    positions = docs.select("text").mapInArrow(_positions(min_chars, log_bits), "segment int, once binary, twice binary")
    parts = positions.groupBy("segment").applyInArrow(_segment_filter(log_bits), "segment int, bits binary").collect()  # bounded: the filter
    whole = np.zeros(1 << (log_bits - 3), np.uint8)
    per = len(whole) // SEGMENTS
    for r in parts:
        whole[r.segment * per:(r.segment + 1) * per] = np.frombuffer(r.bits, np.uint8)
    bits = spark.sparkContext.broadcast(whole.tobytes())
    suspects = durable(docs.where("doc_id is not null").mapInArrow(_suspects(min_chars, log_bits, bits), "doc_id bigint, text_key bigint, line int, key binary"))
    confirmed = suspects.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    confirmed = durable(confirmed)  # as a table of its own it leaves the join's shuffle free to be split at hot keys
    return (suspects.join(confirmed.select("key", "first"), "key").where("doc_id != first")
            .groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("drop")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): the text without the lines that an earlier document holds.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased.  A key of ``min_chars`` code points
    or more that two doc_ids hold stays only in the smaller, with all its lines there.  Null and empty
    texts are one empty line.  Rows that share a doc_id count as one holder, and each loses its own lines (rows are told apart by xxhash64 of the text); a row
    without doc_id loses nothing and holds nothing back.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    drops = repeated_lines(docs, min_chars)
    lines = F.split("text", "\n", -1)
    keep = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                    lambda s: ~F.array_contains("drop", s["i"]))
    kept = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda s: s["x"]), "\n"))
    return (docs.join(drops, ["doc_id", "text_key"], "left")
            .select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                    F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept")))
