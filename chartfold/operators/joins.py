"""Join helpers: broadcast only behind a bound on rows and bytes, null-safe key conditions, semi and anti joins by a key filter.

A semi or anti join of a large table with many keys shuffles every row of the table.  ``rows_with_keys`` and ``rows_without_keys``
first look each row up in a bitmap of the keys' hashes.  It has a bounded size whatever the number of keys, so it is broadcast without a count.
A row whose bit is not set has no match and is not shuffled; the others, few of them false hits, go through the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dictionary table broadcast to every executor must stay well inside executor memory.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


_DECIDED: dict = {}


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if df has at most ``max_rows`` rows of ``max_bytes`` together, else df unchanged.

    The check reads at most ``max_rows + 1`` rows, so its cost is bounded.
    Beyond the bound the join stays a shuffle join (AQE may still switch it
    to a broadcast at runtime from the measured shuffle size).
    """
    return bounded_broadcasts([df], max_rows, max_bytes)[0]


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory, about: 8 a fixed-width column, the length and 16 of any other."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) + 16
        else:
            total = total + 8
    return total


def _decision_key(df: DataFrame, max_rows: int, max_bytes: int):
    # the plan alone is the same after a folder has grown: the size of its files is not
    plan = df._jdf.queryExecution().optimizedPlan()
    sizes = tuple(str(leaf.stats().sizeInBytes()) for leaf in _seq(plan.collectLeaves()))
    return df.sparkSession.sparkContext.applicationId, df.semanticHash(), sizes, max_rows, max_bytes


def _seq(scala_seq):
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def bounded_broadcasts(dfs, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> list[DataFrame]:
    """``bounded_broadcast`` for several tables with one bounded counting job.

    A decision is remembered for the same plan over files of the same size, so a
    dimension that is joined again in the same session is not counted twice and one that has grown is.
    """
    dfs = list(dfs)
    keys = [_decision_key(d, max_rows, max_bytes) for d in dfs]
    todo = [i for i, k in enumerate(keys) if k not in _DECIDED]
    if todo:
        parts = [dfs[i].limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(dfs[i])).alias("b"))
                 .select(F.lit(j).alias("i"), "n", "b") for j, i in enumerate(todo)]
        counts = parts[0]
        for p in parts[1:]:
            counts = counts.unionByName(p)
        for row in counts.collect():   # one row per table
            _DECIDED[keys[todo[row["i"]]]] = row["n"] <= max_rows and (row["b"] or 0) <= max_bytes
    return [F.broadcast(d) if _DECIDED[k] else d for d, k in zip(dfs, keys)]


def null_safe_keys(left: DataFrame, right: DataFrame, keys, right_keys=None) -> Column:
    """``l.k1 <=> r.k1 AND ...`` (NULL keys match each other, as in a key-merge)."""
    right_keys = right_keys or keys
    cond = None
    for lk, rk in zip(keys, right_keys):
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


#: Bits of a key filter: 8 MB on the driver and on each executor, whatever the number of keys; where a caller knows
#: their number, ``BITS_A_KEY`` for each of them up to ``MOST_FILTER_BITS`` (64 MB), so that many keys do not fill it.
FILTER_BITS = 1 << 26
MOST_FILTER_BITS = 1 << 29
BITS_A_KEY = 8


def filter_bits(n_keys: int | None = None) -> int:
    """A power of two."""
    return max(FILTER_BITS, min(MOST_FILTER_BITS, 1 << (BITS_A_KEY * (n_keys or 1) - 1).bit_length()))


def _key_bit(cols, bits: int) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit(bits - 1))


def key_filter(df: DataFrame, bits: int | None = None) -> DataFrame:
    """(x_page, x_words): a bitmap of the hashes of all columns of ``df``, 512 words a page; at most ``bits`` / 2^15 rows."""
    words = (df.select(_key_bit([F.col("`" + c + "`") for c in df.columns], bits or FILTER_BITS).alias("x_bit"))
             .groupBy(F.expr("shiftright(x_bit, 6)").alias("x_word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(x_bit & 63L as int)))").alias("x_ones")))
    pages = (words.groupBy(F.expr("shiftright(x_word, 9)").alias("x_page"))
             .agg(F.expr("map_from_entries(collect_list(struct(cast(x_word & 511L as int), x_ones)))").alias("x_map")))
    return pages.select("x_page", F.expr("transform(sequence(0, 511), i -> coalesce(try_element_at(x_map, i), 0L))").alias("x_words"))


def _filtered(df: DataFrame, other: DataFrame, keys, null_safe: bool, n_keys: int | None = None):
    """(rows surely without a match, rows to be joined, the other side's keys, the condition); None first where hashes cannot be compared."""
    keys = list(keys)
    ok = other.select(*[F.col("`" + k + "`").alias("x_k_" + k) for k in keys])
    renamed = ["x_k_" + k for k in keys]

    def condition(rows):
        if null_safe:
            return null_safe_keys(rows, ok, keys, renamed)
        cond = None
        for k, r in zip(keys, renamed):
            c = rows[k] == ok[r]
            cond = c if cond is None else cond & c
        return cond
    if [df.schema[k].dataType for k in keys] != [f.dataType for f in ok.schema.fields]:
        return None, df, ok, condition(df)
    bits = filter_bits(n_keys)
    marked = (df.withColumn("x_bit", _key_bit([F.col("`" + k + "`") for k in keys], bits))
              .join(F.broadcast(key_filter(ok, bits)), F.expr("shiftright(x_bit, 15)") == F.col("x_page"), "left"))
    word = F.expr("coalesce(get(x_words, cast(shiftright(x_bit, 6) & 511L as int)), 0L)")
    hit = F.expr("shiftleft(1L, cast(x_bit & 63L as int))").bitwiseAND(word) != 0
    columns = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    maybe = marked.where(hit).select(*columns)
    return marked.where(~hit).select(*columns), maybe, ok, condition(maybe)


def rows_by_key_filter(df: DataFrame, other: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` whose keys are surely not in ``other``, the rest); keys are compared null-safe and have one type on both sides."""
    free, maybe, _, _ = _filtered(df, other, keys, True)
    return (df.limit(0) if free is None else free), maybe


def rows_with_keys(df: DataFrame, other: DataFrame, keys, null_safe: bool = False, n_keys: int | None = None) -> DataFrame:
    """``df LEFT SEMI JOIN other`` on columns that both have; only rows that the filter lets through are shuffled.  ``n_keys``: rows of ``other``, where known."""
    _, maybe, ok, cond = _filtered(df, other, keys, null_safe, n_keys)
    return maybe.join(ok, cond, "left_semi")


def parts_without_keys(df: DataFrame, other: DataFrame, keys, null_safe: bool = False, n_keys: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``rows_without_keys`` in two parts: the rows that the filter stops, as ``df`` holds them, and those that went through the exact join."""
    free, maybe, ok, cond = _filtered(df, other, keys, null_safe, n_keys)
    return (df.limit(0) if free is None else free), maybe.join(ok, cond, "left_anti")


def rows_without_keys(df: DataFrame, other: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    """``df LEFT ANTI JOIN other`` on columns that both have; rows that the filter stops have no match and are kept where they are."""
    free, rest = parts_without_keys(df, other, keys, null_safe)
    return free.unionByName(rest)
