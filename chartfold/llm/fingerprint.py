"""Document fingerprints by consistent weighted sampling.

The terms of a text of any length are its pairs of adjacent words with their counts as weights, and with a fifth of the
weight the pieces of its words, as few words say little: a word is cut after every 4 bytes whose hash has
``PIECE_BITS`` leading zeros, so a cut depends on the bytes around it alone, and one word without any space has pieces too.  For each of K samples a
term has r, c ~ Gamma(2, 1) and b ~ U(0, 1); with t = floor(ln w / r + b) it scores ln c - r (t - b + 1), and the term of the least
score with its t is the sample.  Two texts have the same sample with the probability of their generalised Jaccard
likeness sum min(w) / sum max(w).  The random variables come from a seeded table of 32,768 rows,
addressed by the term's hash.  A fingerprint holds 16 bits of each sample as hexadecimal digits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, mix_int, not_space, word_hashes
from .ranges import deal_by_id

SAMPLES = 64
TABLE_ROWS = 1 << 15
PIECE_BITS = 3                      # 2**3 bytes in a piece of a long word, about
_PAIR = np.uint64(mix_int(31) | 1)
_SPACE = not_space()
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += np.uint8(32)
_TABLES: dict = {}


def _tables(samples: int, seed: int = 20240101):
    if samples not in _TABLES:
        rng = np.random.default_rng(seed)
        shape = (TABLE_ROWS, samples)
        r = (rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        b = rng.random(shape).astype(np.float32)
        _TABLES[samples] = (np.float32(1) / r, r, c, b)
    return _TABLES[samples]


def weighted_terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes uint64, weights float32) of a text; empty for one without any word."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.float32)
    data = np.frombuffer(text, np.uint8)
    words, _ = word_hashes(data, np.array([0, len(data)], np.int64), _SPACE)
    pairs, counts = np.unique(mix(words[:-1] * _PAIR + words[1:]), return_counts=True)
    low = _LOW[data]
    grams = np.ndarray(max(0, len(low) - 3), "<u4", low, strides=(1,)) * np.uint32(0x9E3779B1)
    cut = np.insert(data, np.flatnonzero(grams >> np.uint32(32 - PIECE_BITS) == 0) + 4, 0x20)
    pieces, _ = word_hashes(cut, np.array([0, len(cut)], np.int64), _SPACE)
    pieces, more = np.unique(mix(pieces + _PAIR), return_counts=True)
    return np.concatenate((pairs, pieces)), np.concatenate((counts.astype(np.float32), more.astype(np.float32) / 5))


def sample_text(text: bytes, samples: int = SAMPLES) -> np.ndarray:
    """uint16 codes of the K consistent weighted samples; all zero for an empty text."""
    terms, weights = weighted_terms(text)
    if not len(terms):
        return np.zeros(samples, np.uint16)
    inv, r, c, b = _tables(samples)
    best = np.full(samples, np.inf, np.float32)
    code = np.zeros(samples, np.uint64)
    logs = np.log(weights).astype(np.float32)
    for lo in range(0, len(terms), 2048):  # a long text has its terms taken in blocks
        part = terms[lo:lo + 2048]
        at = (part >> np.uint64(49)).astype(np.int64)
        beta = b[at]
        t = inv[at]
        t *= logs[lo:lo + 2048, None]
        t += beta
        np.floor(t, out=t)
        beta -= t
        beta -= 1
        beta *= r[at]
        beta += c[at]                      # ln c - r (t - b + 1)
        win = beta.argmin(axis=0)
        cols = np.arange(samples)
        score = beta[win, cols]
        better = score < best
        best[better] = score[better]
        code[better] = mix(part[win] + mix(t[win, cols].astype(np.int64).view(np.uint64)))[better]
    return (code >> np.uint64(48)).astype(np.uint16)


def to_text(sample: np.ndarray) -> str:
    return sample.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: the estimate of the generalised Jaccard likeness."""
    return float((a == b).mean())


def _walk(samples: int):
    """Rows come in order of (part, doc_id); each is compared with the row after it, ``guard`` rows only as successors."""
    def row(doc, text, own, follow):
        after, theirs = follow
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        mark = sample_text(edited.encode("utf-8", "surrogatepass"), samples)
        return (doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own), to_text(mark),
                likeness(own, mark), likeness(own, theirs))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        last = None
        for batch in batches:
            out = []
            for part, doc, text, guard in zip(*(batch.column(c) for c in ("part", "doc_id", "text", "guard"))):
                part, doc, text, guard = part.as_py(), doc.as_py(), text.as_py(), guard.as_py()
                own = sample_text(text.encode("utf-8", "surrogatepass"), samples)
                if last is not None and last[0] == part:
                    out.append(row(*last[1:], (text, own)))
                last = None if guard else (part, doc, text, own)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), type=t) for x, t in zip(zip(*out) if out else [[]] * 7, (
                pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=names)
    return run


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint of every text and of its edited text (its last half replaced by the start of the next document).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  Null text counts as empty; equal
    texts have equal fingerprints, two empty ones likeness 1.  The next document is the one with the next doc_id (ties:
    the greater text hash; null ids come first), after the last the first; a single row follows itself.  Other columns are
    ignored.  Rows move once, by ranges of doc_id; each range also gets the first row of the range after it.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt, parts = deal_by_id(docs)
    dealt = dealt.withColumn("tie", F.xxhash64("text"))
    firsts = sorted((r.part, r.x.doc_id, r.x.tie) for r in
                    dealt.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("x")).collect())  # one row a range
    spark = docs.sparkSession
    marks = spark.createDataFrame([(firsts[i - 1][0], d, t) for i, (_, d, t) in enumerate(firsts)], "to int, id long, mark long")
    first = (docs.withColumn("tie", F.xxhash64("text")).join(F.broadcast(marks), F.expr("doc_id <=> id and tie = mark"))
             .dropDuplicates(["to"]).select(F.col("to").alias("part"), "doc_id", "text", "tie", F.lit(True).alias("guard")))
    rows = dealt.withColumn("guard", F.lit(False)).unionByName(first)
    ordered = rows.repartitionById(max(1, parts), "part").sortWithinPartitions("part", "guard", "doc_id", "tie")
    return ordered.select("part", "doc_id", "text", "guard").mapInArrow(
        _walk(samples), "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
