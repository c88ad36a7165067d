"""Mixing to target weights with soft domain membership.

A softmax model, fitted on the labelled table, gives each document its posteriors over domains.  Rates (expected copies) x >= 0 are
chosen so that the expected domain totals sum_d x_d t_d p_dk (t: tokens) meet the targets: the least-squares distance to the targets
is lowered by projected gradient steps x_d <- max(0, x_d + p_d . s).  The step s is the gradient scaled by
the inverse of the domains' Gram matrix over documents with a positive rate.  Every round is one pass over (t, p) in
which Spark sums K totals and K x K products; the driver holds these and the steps so far, never a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_parts, durable
from .linear import fit, posteriors

TRAIN_ROWS = 20_000             # labelled rows that the model is fitted on, about, at most
ROUNDS = 40
TOLERANCE = 1e-6                # relative distance of the totals from the targets at which rounds end
#: Domains of the production query: labels.quality 0 and 1, and the shares of all tokens that they are to have.
TARGETS = (0.05, 0.95)
TEXT_FEATURES = 12


def text_features(column) -> np.ndarray:
    """Shares of byte classes and word and line statistics of every text of an Arrow column."""
    off, data = binary_parts(column)
    kinds = np.zeros((256, 9), np.float64)
    kinds[65:91, 0] = 1                                         # upper case
    kinds[97:123, 1] = 1                                        # lower case
    kinds[48:58, 2] = 1                                         # digits
    kinds[128:, 3] = 1                                          # beyond ASCII
    kinds[[32, 9, 10, 13], 4] = 1                               # white space
    kinds[[10], 5] = 1                                          # line ends
    kinds[[ord(c) for c in ".,;:"], 6] = 1                      # common marks
    kinds[[ord(c) for c in "!?"], 7] = 1
    kinds[:, 8] = (kinds[:, :8].sum(axis=1) == 0)               # all other marks
    out = np.zeros((len(off) - 1, TEXT_FEATURES))
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        if a == b:
            continue
        hist = np.bincount(data[a:b], minlength=256)
        share = hist @ kinds / (b - a)
        out[i, :9] = np.sqrt(share)
        out[i, 9] = np.log1p(b - a)
        out[i, 10] = np.log1p(share[4] and 1 / share[4])        # bytes to a space
        out[i, 11] = share[0] / (share[0] + share[1] + 1e-9)
    return out


def _sample_features(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(list(text_features(batch.column("text"))), pa.list_(pa.float64())), batch.column("y")], names=["x", "y"])


def train_domains(docs: DataFrame, labels: DataFrame, label: str = "quality", classes: int = 2, rows: int = TRAIN_ROWS) -> dict:
    """Softmax model of the domain from a labelled table; nulls and values outside 0..classes-1 are left out."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .where(f"doc_id is not null and y >= 0 and y < {classes}").groupBy("doc_id").agg(F.max("y").alias("y")))
    total = marked.count()
    if total > rows:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / total))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = (texts.join(F.broadcast(marked), "doc_id").select("text", "y").mapInArrow(_sample_features, "x array<double>, y int")).collect()
    return fit(np.array([r.x for r in made], float).reshape(-1, TEXT_FEATURES), np.array([r.y for r in made], int), classes)


def _placed(model):
    """Posteriors of a text.  Only texts go to Python; not deterministic to Spark, so that a filter on the result does not run it again."""
    @F.arrow_udf("array<double>")
    def place(text: pa.Array) -> pa.Array:
        return pa.array(list(posteriors(model, text_features(text))), pa.list_(pa.float64()))
    return place.asNondeterministic()


def _rates(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    x = np.ones(len(p))
    for s in steps:
        x = np.maximum(0.0, x + p @ s)
    return x


def _totals(steps, classes):
    """Map side: sums of x t p and of t p p' over documents whose rate is positive, one row a task."""
    def run(batches):
        total, gram = np.zeros(classes), np.zeros((classes, classes))
        for batch in batches:
            p = np.array(batch.column("p").to_pylist(), float).reshape(-1, classes)
            t = np.array(batch.column("tokens").to_pylist(), float)
            x = _rates(p, steps)
            total += (x * t) @ p
            live = p * ((x > 0) * t)[:, None]
            gram += live.T @ p
        sums = np.concatenate((total, gram.ravel())).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.float64()) for v in sums], names=[f"v{i}" for i in range(len(sums))])
    return run


def fit_rates(weights: DataFrame, targets: list[float], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """Steps of the projected gradient rounds over (tokens, p); they give every document its rate."""
    k, steps, goal = len(targets), [], np.array(targets, float)
    names = [f"v{i}" for i in range(k + k * k)]
    for _ in range(rounds):
        made = weights.mapInArrow(_totals(steps, k), ", ".join(f"{c} double" for c in names))
        sums = np.array([v or 0.0 for v in made.agg(*[F.sum(c) for c in names]).first()])
        total, gram = sums[:k], sums[k:].reshape(k, k)
        gap = goal - total
        if np.abs(gap).max() <= tolerance * max(1.0, goal.sum()) or not gram.any():
            break
        # negative gradient is t p . gap; the Gram matrix scales it to the distance that is left
        steps.append(np.linalg.lstsq(gram + 1e-9 * np.trace(gram) * np.eye(k), gap, rcond=None)[0])
    return steps


def _rated(model, steps):
    """Posteriors and rate of a text, in one call: a document goes to one Python worker, once."""
    @F.arrow_udf("struct<p: array<double>, rate: double>")
    def rate(text: pa.Array) -> pa.Array:
        p = posteriors(model, text_features(text))
        return pa.StructArray.from_arrays([pa.array(list(p), pa.list_(pa.float64())), pa.array(_rates(p, steps), pa.float64())], names=["p", "rate"])
    return rate.asNondeterministic()


def mix(docs: DataFrame, model: dict, shares=TARGETS) -> DataFrame:
    """(row, tokens, p, rate): every row of ``docs`` as the struct ``row`` with domain posteriors and its rate.

    ``shares``: shares of the domains in the token total, which stays as it is.  tokens: runs of non-white characters; null and
    empty texts have none and count in no total, but have a rate like all others.  A target that no rate can
    meet is met as nearly as possible.  An empty table gives no rows.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    frame = docs.select(whole, text.alias("text"), F.size(F.array_remove(F.split(text, r"\s+"), "")).cast("long").alias("tokens"))
    weights = durable(frame.select("tokens", _placed(model)("text").alias("p")))
    # a pass reads three numbers a document: a task a core, not one for every partition of the texts, many times over
    weights = weights.coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism))
    total = weights.agg(F.sum("tokens")).first()[0] or 0
    steps = fit_rates(weights, [s / sum(shares) * total for s in shares])
    return frame.select("row", "tokens", _rated(model, steps)("text").alias("r")).select("row", "tokens", "r.p", "r.rate")


def copies(doc_id, rate, salt: str = "mix"):
    """Whole number of copies with the expected value ``rate``: the fraction is settled by a hash of the id."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("int")
