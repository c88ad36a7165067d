"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A benchmark item gives windows of ``width`` adjacent words (a shorter item: all its words).  A window occurs in a
document only if its rarest word does, so that word with its place in the window is the necessary prefix token: rarity is counted
over all documents.  Document words meet the windows on that token; the position bounds drop starts outside the
document, and the words at the start are compared with the whole window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, durable

WIDTH = 10
#: Everything but 0-9, a-z and non-ASCII once A-Z are lower-cased; A-Z are left in, as words are lower-cased late.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000       # windows broadcast at most; beyond, both sides are shuffled


def words_of(text):
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), "")


def _small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(win, len, items): distinct windows as words joined by a space, with the ids of the items that hold them."""
    low = F.translate(F.array_join("w", " "), UPPER, LOWER)
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where("item_id is not null and size(w) > 0")
    items = items.select("item_id", F.split(low, " ").alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return (items.select("item_id", "w", F.explode(starts).alias("at"))
            .select("item_id", F.expr(f"slice(w, at, {width})").alias("w"))
            .groupBy(F.array_join("w", " ").alias("win")).agg(F.first(F.size("w")).alias("len"), F.collect_set("item_id").alias("items")))


def prefix_tokens(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """(token, off, len, win, items): the rarest word of every window that can occur, with its place (from 0).

    A token is in full lower case, which only widens the search: the comparison afterwards lowers A-Z alone.
    """
    at = windows.select("win", F.posexplode(F.split(F.lower("win"), " ")).alias("off", "token"))
    vocabulary = _small(durable(at.select("token").distinct()))
    counts = (docs.select(F.explode(words_of(F.col("text"))).alias("token")).select(F.lower("token").alias("token"))
              .join(vocabulary, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rarest = at.join(counts, "token", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"), F.col("off"))).alias("x"))
    return (windows.join(rarest, "win").where("x.n > 0")
            .select(F.col("x.token").alias("token"), F.col("x.off").alias("off"), "len", "win", "items"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, n_words, hits, n_hit, items): every row of ``docs`` as the struct ``doc`` with the windows that occur in it.

    hits: array of (start from 1, len, items); n_hit: words inside any of them; items: their distinct item ids.  Null and
    empty texts have no words and no hits; null item ids and items without words are left out; repeated items count once;
    an empty benchmark hits nothing.  Rows that share a doc_id, null too, are judged each on its own words.  All columns of
    ``docs`` stay inside ``doc``, so none can clash.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    body = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    windows = durable(benchmark_windows(benchmark, width))
    prefix = _small(durable(prefix_tokens(windows, body)))
    words = body.select("id", words_of(F.col("text")).alias("w"))
    spread = words.select("id", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word")).select("id", "n", "pos", F.lower("word").alias("token"))
    met = (spread.join(prefix, "token").where("pos >= off and pos - off + len <= n")
           .select("id", F.struct((F.col("pos") - F.col("off") + 1).alias("start"), "len", "win", "items").alias("c")))
    found = met.groupBy("id").agg(F.collect_set("c").alias("met"))
    seen = whole.join(found, F.col("doc.doc_id").eqNullSafe(F.col("id")), "left")
    # the lambda variable keeps the words from being split again for each candidate
    low = f"translate(array_join(slice(w, c.start, c.len), ' '), '{UPPER}', '{LOWER}')"
    judged = seen.withColumn("w", words_of(F.col("doc.text"))).select(
        "doc", F.expr(f"""transform(array(w), w -> struct(size(w) as n_words,
            transform(filter(coalesce(met, array()), c -> c.start + c.len - 1 <= size(w) and {low} = c.win),
                      c -> struct(c.start as start, c.len as len, c.items as items)) as hits))[0]""").alias("x"))
    return judged.select("doc", F.col("x.n_words").cast("long").alias("n_words"), F.col("x.hits").alias("hits")).select(
        "doc", "n_words", "hits",
        F.expr("size(array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.len - 1)))))").cast("long").alias("n_hit"),
        F.expr("array_distinct(flatten(transform(hits, h -> h.items)))").alias("items"))
