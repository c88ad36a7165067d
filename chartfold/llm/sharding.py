"""Byte-balanced shards by Karmarkar-Karp differencing.

Groups of equal texts are indivisible.  A partial partition is a vector of shard sums; differencing takes the two of
the largest spread and adds them in opposite order, until one is left.  Buckets of groups are differenced in their
own tasks; the partial partitions that they leave are differenced in turn, bucket by bucket, until one
bucket holds all.  No task sees more than a bucket, and the driver none of it.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

SHARDS = 24
GROUPS_A_BUCKET = 20_000       # groups differenced in one task
PARTIALS_A_BUCKET = 1_000      # partial partitions differenced in one task
ROWS_A_CHUNK = 4_096           # rows numbered together within a shard


def difference(vectors: list[list[tuple[int, int]]], shards: int) -> list[int]:
    """Shard of every leaf.  ``vectors``: partial partitions as lists of (sum, leaf); leaves are numbered from 0.

    Ties go by the order of the input, so the result depends on nothing else.
    """
    leaves = sum(map(len, vectors))
    parent = [-1] * leaves
    heap = []
    for i, v in enumerate(vectors):
        v = sorted(v, reverse=True)
        v += [(0, -1)] * (shards - len(v))
        heap.append((v[-1][0] - v[0][0], i, v))
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        out = []
        for (x, p), (y, q) in zip(a, reversed(b)):
            if p < 0 or q < 0:
                out.append((x + y, max(p, q)))
            else:
                node = len(parent)
                parent.append(-1)
                parent[p] = parent[q] = node
                out.append((x + y, node))
        out.sort(reverse=True)
        heapq.heappush(heap, (out[-1][0] - out[0][0], turn, out))
        turn += 1
    shard = [0] * len(parent)
    if heap:
        for s, (_, node) in enumerate(heap[0][2]):
            if node >= 0:
                shard[node] = s
    for node in range(len(parent) - 1, -1, -1):  # parents come after their children
        if parent[node] >= 0:
            shard[node] = shard[parent[node]]
    return shard[:leaves]


def _difference_groups(shards: int):
    def run(t):
        order = t.sort_by([("total", "descending"), ("key", "ascending")])
        leaves = order.column("total").to_pylist()
        placed = difference([[(w, i)] for i, w in enumerate(leaves)], shards)
        return order.select(["bucket", "key", "total"]).append_column("subset", pa.array(placed, pa.int32()))
    return run


def _difference_partials(shards: int):
    def run(t):
        order = t.sort_by([("bucket", "ascending"), ("subset", "ascending")])
        vectors, last = [], None
        for i, (b, w) in enumerate(zip(order.column("bucket").to_pylist(), order.column("total").to_pylist())):
            if b != last:
                vectors.append([])
                last = b
            vectors[-1].append((w, i))
        return order.append_column("into", pa.array(difference(vectors, shards), pa.int32()))
    return run


def place_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(key, shard) for groups (key, total): distinct keys with their sizes."""
    buckets = groups.count() // GROUPS_A_BUCKET + 1
    groups = groups.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", F.col("total").cast("long").alias("total"))
    placed = durable(groups.groupBy("bucket").applyInArrow(_difference_groups(shards), "bucket long, key string, total long, subset int"))
    parts = placed.groupBy("bucket", "subset").agg(F.sum("total").alias("total"))
    route = None                                      # (bucket, subset) of the first level -> place on the level reached
    while buckets > 1:
        buckets = (buckets - 1) // PARTIALS_A_BUCKET + 1
        above = parts.withColumn("up", F.expr(f"bucket div {PARTIALS_A_BUCKET}"))
        step = durable(above.groupBy("up").applyInArrow(_difference_partials(shards), "bucket long, subset int, total long, up long, into int"))
        parts = step.groupBy(F.col("up").alias("bucket"), F.col("into").alias("subset")).agg(F.sum("total").alias("total"))
        step = step.select("bucket", "subset", "up", "into")
        if route is None:
            route = step
        else:
            step = step.select(*[F.col(a).alias(b) for a, b in (("bucket", "up"), ("subset", "into"), ("up", "up2"), ("into", "into2"))])
            route = route.join(step, ["up", "into"]).select("bucket", "subset", F.col("up2").alias("up"), F.col("into2").alias("into"))
    if route is None:
        return placed.select("key", F.col("subset").alias("shard"))
    return placed.join(route, ["bucket", "subset"]).select("key", F.col("into").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): law ``bytes``, groups of equal texts kept whole.

    size: UTF-8 bytes of the text plus 8; null text counts as empty and is in the group of empty texts.  slot numbers the
    rows of a shard without gaps from 0.  Repeated and null doc_ids are rows of their own.  A group larger than a shard's
    share fills its shard alone.  An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("key"))
    rows = durable(rows)
    groups = rows.groupBy("key").agg(F.sum("size").alias("total"))
    placed = rows.join(place_groups(groups, shards), "key")
    chunks = rows.count() // (shards * ROWS_A_CHUNK) + 1
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    counts = placed.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "chunk", (F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32")) - 1
    return (placed.withColumn("at", within).join(before, ["shard", "chunk"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("at") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
