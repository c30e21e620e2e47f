"""Distributed numbering and running sums against plain windows, with skew and ties."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from abacarium.operators.ordering import global_index, global_ranks, running_sums


def _skewed(spark, rows=3000):
    """A third of the rows has key 0; values repeat often."""
    i = F.col("id")
    return spark.range(rows, numPartitions=5).select(
        i, F.when(i % 3 == 0, 0).otherwise(i % 17).alias("k"),
        F.when(i % 5 == 0, F.lit(None)).otherwise(i * 7919 % 40).cast("decimal(12,2)").alias("v"))


def test_global_index_is_dense_and_ordered(spark):
    df = _skewed(spark)
    found = global_index(df, [F.desc("v"), "id"])
    window = Window.orderBy(F.desc("v"), "id")
    expected = df.select("id", F.row_number().over(window).cast("long").alias("row_num"))
    assert sorted(found.select("id", "row_num").collect()) == sorted(expected.collect())


@pytest.mark.parametrize("slices", [None, 1, 7, 90])
def test_ranks_within_skewed_groups(spark, slices):
    """With 90 slices runs of ties go on over several slices."""
    df = _skewed(spark).withColumn("k", F.nullif("k", F.lit(5)))
    found = global_ranks(df, [F.desc("v")], ["v"], ["id"], within=["k"], slices=slices)
    window = Window.partitionBy("k").orderBy(F.desc("v"))
    expected = df.select(
        "id", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id")).cast("long"),
        F.rank().over(window).cast("long"), F.dense_rank().over(window).cast("long"))
    assert sorted(found.select("id", "row_num", "rnk", "dense_rnk").collect()) == sorted(expected.collect())


def test_running_sums_cut_every_key(spark):
    df = _skewed(spark).withColumn("add", F.coalesce("v", F.lit(0))).withColumn("k", F.nullif("k", F.lit(5)))
    window = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = sorted(df.select("id", F.sum("add").over(window).alias("total")).collect())
    for slices in (1, 9, 60, None):
        found = running_sums(df, ["k"], ["id"], {"total": F.col("add")}, slices)
        assert sorted(found.select("id", "total").collect()) == expected, slices


def test_ranks_without_groups(spark):
    df = _skewed(spark)
    found = global_ranks(df, [F.desc("v")], ["v"], ["id"], slices=40)
    window = Window.orderBy(F.desc("v"))
    expected = df.select("id", F.row_number().over(Window.orderBy(F.desc("v"), "id")).cast("long"),
                         F.rank().over(window).cast("long"), F.dense_rank().over(window).cast("long"))
    assert sorted(found.select("id", "row_num", "rnk", "dense_rnk").collect()) == sorted(expected.collect())
