"""A checkpoint leaves no shuffle files behind: a stage of many checkpoints holds the disk of one of them."""

import time

from pyspark.sql import functions as F

from chartfold.llm.common import DROP_SHUFFLES, durable


def _shuffle_blocks(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(found.apply(i)) for i in range(found.size()) if str(found.apply(i)).startswith("shuffle_")}


def test_a_checkpoint_drops_the_shuffles_it_was_made_from(spark):
    before, setting = _shuffle_blocks(spark), spark.conf.get(DROP_SHUFFLES, None)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    held = [durable(counts.where(F.col("k") >= i)) for i in range(3)]
    end = time.time() + 20
    while _shuffle_blocks(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffle_blocks(spark) - before
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    assert [df.count() for df in held] == [7, 6, 5]
    assert sorted(tuple(r) for r in counts.collect()) == sorted(tuple(r) for r in held[0].collect())
