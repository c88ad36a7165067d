"""Joins whose heavy keys are split apart.

A mergeable sketch of frequent items runs over the key column of the big side: each task keeps a
bounded summary, the summaries are merged, and one row comes back with the keys that hold more than a
share of the rows, NULL among them.  Only these keys are treated apart:

* rows of a heavy key are dealt over as many pieces as fit their share, by a hash of a row id (a rerun of a
  lost task deals them alike), and the other side's rows of that key are copied once a piece,
* rows without a key match nothing: they are dealt over pieces in the same way, and nothing is copied for them,
* every other key keeps its one piece.

It is one shuffle join with one read of the big side, and it has the rows of the plain join.  Without heavy keys it is the plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key is heavy when it holds more than this part of an even shuffle partition.
HEAVY_FILL = 0.25
#: Pieces per even partition's worth of rows: so many that their hashes spread evenly.
PIECES = 16
#: The sketch tracks at most this many items; its error is below 2.7 / items of all rows.
MOST_ITEMS = 1_000_000
LEAST_SHARE = 8 / MOST_ITEMS


def heavy_keys(df: DataFrame, key: str, share: float) -> list[tuple]:
    """[(key, estimated rows, share)] of the keys that may hold ``share`` of the rows or more, NULL included; most rows first.

    No key of that share is missed; some of half of it and more may be among them.  At most 2 / ``share`` rows reach the driver.
    A share below ``LEAST_SHARE`` is taken as that.  An empty table has none.
    """
    share = max(share, LEAST_SHARE)
    items = min(MOST_ITEMS, max(10_000, math.ceil(8 / share)))
    most = min(items, 100_000, math.ceil(2 / share) + 1)
    top = F.expr(f"approx_top_k(`{key}`, {most}, {items})")
    row = df.select(key).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    if not row["n"]:
        return []
    # a sketch's estimate is off by less than a third of the share: keys near it stay in
    return [(r["item"], r["count"], r["count"] / row["n"]) for r in row["top"] or [] if r["count"] >= share * row["n"] / 2]


def heavy_key_counts(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n_rows): exactly the keys that hold ``share`` of the rows or more, NULL included, with exact counts.

    The sketch names the candidates; a second read counts these alone.  An empty table gives no row.
    """
    rows = _keys_frame(df, key, [(k, 1) for k, _, _ in heavy_keys(df, key, share)])
    total = df.agg(F.count(F.lit(1)).alias("x_total"))
    counted = (df.select(key).join(F.broadcast(rows), F.col(key).eqNullSafe(F.col("x_heavy")), "left_semi")
               .groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")))
    return counted.join(F.broadcast(total), F.col("n_rows") >= F.lit(share) * F.col("x_total")).select(key, "n_rows")


def _keys_frame(df: DataFrame, key: str, rows) -> DataFrame:
    schema = T.StructType([T.StructField("x_heavy", df.schema[key].dataType), T.StructField("x_pieces", T.IntegerType())])
    return df.sparkSession.createDataFrame(rows, schema)


def split_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left", spread: str | None = None,
               partitions: int | None = None) -> DataFrame:
    """``left JOIN right ON left_key = right_key`` (``left`` or ``inner``) with the heavy keys of ``left`` split.

    ``spread`` is a column of ``left`` whose values differ within a key (a row id); without it the whole row deals the pieces, so
    repeated rows stay together.  Both sides keep all their columns, whose names must differ.  Rows, nulls and repeated rows are those of the plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: only left and inner")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    partitions = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, left_key, HEAVY_FILL / partitions)
    if not heavy or partitions == 1:
        return left.join(right, F.col(left_key) == F.col(right_key), how)
    # 2 / share keys at most, as heavy_keys says
    pieces = F.broadcast(_keys_frame(left, left_key, [(k, math.ceil(share * partitions * PIECES)) for k, _, share in heavy]))
    row_id = [F.col(f"`{spread}`")] if spread else [F.col(f"`{c}`") for c in left.columns]
    dealt = (left.join(pieces, F.col(f"`{left_key}`").eqNullSafe(F.col("x_heavy")), "left")
             .withColumn("x_piece", F.coalesce(F.pmod(F.xxhash64(*row_id), F.col("x_pieces")).cast("int"), F.lit(0)))
             .drop("x_heavy", "x_pieces"))
    copied = (right.join(pieces, F.col(f"`{right_key}`") == F.col("x_heavy"), "left")
              .withColumn("x_copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("x_pieces") - 1, F.lit(0)))))
              .drop("x_heavy", "x_pieces"))
    out = dealt.join(copied, (F.col(f"`{left_key}`") == F.col(f"`{right_key}`")) & (F.col("x_piece") == F.col("x_copy")), how)
    return out.select(*[F.col(f"`{c}`") for c in (*left.columns, *right.columns)])
