"""Landed change files -> raw tables, as a Structured Streaming job.

``readStream`` over a landing folder, ``trigger(availableNow=True)`` so each
scheduled run drains what has landed and stops; ``foreachBatch`` key-merges
every micro-batch into the stored raw table.  Into a ``ChangeTable`` it writes the
batch's rows only, and compaction bounds what a reader merges; a ``VersionedTable`` is
written whole per batch and is for small tables.  The streaming checkpoint
replaces the loader's cursor state, and the merge is idempotent, so a batch
replayed after a failure leaves the same table.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..catalog import spec as table_spec
from ..operators.upsert import change_order, upsert_by_key
from ..session import storage_root
from ..sources.changes import ChangeTable
from ..sources.storage import VersionedTable


def merge_batch_into(table: VersionedTable, keys, order_by=None,
                     after: Callable[[DataFrame, int], None] | None = None):
    """foreachBatch handler: ``table := upsert_by_key(table, batch)``."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        stored = table.read()
        merged = upsert_by_key(stored, batch, keys, order_by=change_order(batch) if order_by is None else list(order_by), null_safe=False)
        table.write(merged)
        if after is not None:
            after(batch, epoch_id)
    return handle


def append_batch_to(table: ChangeTable, after: Callable[[DataFrame, int], None] | None = None):
    """foreachBatch handler: the batch becomes a change file of the table."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        table.append(batch)
        table.compact()
        if after is not None:
            after(batch, epoch_id)
    return handle


def ingest_available(spark: SparkSession, name: str, landing: str, table: VersionedTable | ChangeTable,
                     schema, checkpoint: str | None = None, files_per_batch: int | None = None,
                     after=None) -> None:
    """Drain the landing folder of table ``name`` into ``table`` and stop."""
    keys = list(table_spec(name).keys)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)
    ckpt = checkpoint or f"{storage_root(spark)}/chartfold/stream-checkpoints/{name}"
    handle = append_batch_to(table, after) if isinstance(table, ChangeTable) else merge_batch_into(table, keys, after=after)
    q = (stream.writeStream.foreachBatch(handle)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
