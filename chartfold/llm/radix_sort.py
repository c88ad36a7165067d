"""Distributed LSD radix sort: stable counting-sort passes over the digits of a composite key.

Rows carry their present place, a pair (``block``, ``at``): blocks of bounded size, ordered by number, and an order inside.
A pass takes one digit.  It counts the digit's values in every block, turns the counts into global prefix offsets
(all rows with a smaller digit, then equal digits of earlier blocks), and adds to each row's offset its number among equal digits of its own
block: the row's destination.  Destinations are gapless, so the next blocks are equal ranges of them, however often a digit or a key occurs.
After the last pass the destination is the rank.  No task sorts more than a block; the driver reads, per pass, one count a
digit value (``2**DIGIT_BITS`` at most), which does not grow with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, shuffle_width

DIGIT_BITS = 14
ROWS_A_BLOCK = 1 << 20


def digits_of(parts: list[tuple[Column, int]], most_bits: int = DIGIT_BITS) -> list[Column]:
    """Digits of a composite key, least significant first; ``parts``: (non-negative long, its bits), most significant first.

    Parts of a few bits together share a digit where they fit.
    """
    out: list[Column] = []
    digit, used = None, 0
    for column, bits in reversed(parts):
        taken = 0
        while taken < bits:
            n = min(most_bits - used, bits - taken)
            piece = F.shiftrightunsigned(column, taken).bitwiseAND((1 << n) - 1)
            digit = piece if digit is None else digit.bitwiseOR(F.shiftleft(piece, used))
            used, taken = used + n, taken + n
            if used == most_bits:
                out.append(digit)
                digit, used = None, 0
    return out + ([digit] if digit is not None else [])


def radix_sort(rows: DataFrame, digits: list[Column], total: int, first: Column) -> DataFrame:
    """``rows`` with ``place``: 0 to total - 1 in the ascending order of the digits (least significant first).

    ``first``: a long that differs from row to row and stays the same when a task is repeated; rows with equal keys keep its
    order inside the blocks of the first pass, which are its remainders.
    """
    spark = rows.sparkSession
    blocks = max(1, min(total, max(shuffle_width(spark), -(-total // ROWS_A_BLOCK))))
    size = max(1, -(-total // blocks))
    now = rows.withColumns({"block": F.pmod(F.xxhash64(first), F.lit(blocks)), "at": first})
    for digit in digits or [F.lit(0)]:
        keyed = now.withColumn("digit", digit.cast("int"))
        counts = durable(keyed.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n")))
        base, run = [], 0
        for r in counts.groupBy("digit").agg(F.sum("n").alias("n")).orderBy("digit").collect():
            base.append((r.digit, run))
            run += r.n
        bases = F.broadcast(spark.createDataFrame(base, "digit int, smaller long"))
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(bases, "digit").select(
            "block", "digit", (F.col("smaller") + F.col("before")).alias("offset"))
        # the offset of a block and digit goes ahead of its rows, so one window gives both the offset and the number in the block
        own = Window.partitionBy("block", "digit").orderBy(F.col("offset").asc_nulls_last(), "at")
        both = keyed.unionByName(offsets, allowMissingColumns=True).repartition(blocks, "block")
        placed = both.withColumn("place", F.first("offset").over(own) + F.row_number().over(own) - 2).where("offset is null")
        now = durable(placed.select(*rows.columns, F.floor(F.col("place") / size).cast("long").alias("block"), F.col("place").alias("at")))
    return now.select(*rows.columns, F.col("at").alias("place"))
