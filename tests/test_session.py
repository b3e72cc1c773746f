import time

import pytest
from pyspark.sql import functions as F

from sectoria.session import SHUFFLE_CLEANUP, cut_lineage


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    """What was exchanged for a stored table goes with the write, not when the driver happens to collect its garbage."""
    before = shuffle_files(spark)
    rows = spark.range(20_000).withColumn("k", F.col("id") % 7).repartition(4, "k")
    sums = rows.groupBy("k").agg(F.sum("id").alias("s"))
    stored = cut_lineage(rows.join(sums, "k"))
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    # The table and the frame it was made of can both be used further.
    assert stored.count() == rows.join(sums, "k").count() == 20_000
    assert cut_lineage(rows).groupBy("k").count().count() == 7


def test_the_option_of_the_session_stays_as_it_was(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    cut_lineage(spark.range(3))
    with pytest.raises(Exception, match="stop"):
        cut_lineage(spark.range(3).select(F.raise_error(F.lit("stop")).alias("x")))
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
