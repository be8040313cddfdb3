"""What staging leaves behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from scrubwell import session


def _shuffles(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_stage_leaves_no_shuffles(spark):
    spark.range(10).count()
    for _ in range(2):
        spark._jvm.System.gc()
    before, setting = _shuffles(spark), spark.conf.get(session.SHUFFLES_GO, None)
    told = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = session.stage(told.join(spark.range(7).repartition(3, "id"), told.k == F.col("id")), "counts")
    assert _shuffles(spark) <= before
    assert spark.conf.get(session.SHUFFLES_GO, None) == setting
    assert table.agg(F.sum("count")).first()[0] == 1000
    # what the table was made of can be run again
    assert told.count() == 7
