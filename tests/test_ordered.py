"""Numbering and carrying forward against windows, with one key that spans all ranges."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.operators.ordered import carried, numbered


@pytest.fixture(scope="module")
def rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 11).cast("string")))
    yield spark.range(20_000).select("id", key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("o"), F.when(F.col("id") % 400 == 0, F.col("id").cast("string")).alias("v")).cache()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers(rows):
    w = Window.partitionBy("k").orderBy("o", "id")
    assert numbered(rows, ["k"], ["o", "id"]).exceptAll(rows.withColumn("rn", F.row_number().over(w).cast("bigint"))).count() == 0
    assert numbered(rows, ["k"], ["o", "id"]).count() == rows.count() and numbered(rows.limit(0), ["k"], ["o", "id"]).count() == 0


def test_carried(rows):
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("c", F.last("v", ignorenulls=True).over(w))
    got = carried(rows, ["k"], ["o", "id"], "v", "c")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and carried(rows.limit(0), ["k"], ["o", "id"], "v", "c").count() == 0
