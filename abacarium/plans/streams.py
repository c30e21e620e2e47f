"""Stream queries: a feed is split into files, streamed, and must end like the batch form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from abacarium.operators.facts import partition_of
from abacarium.plans.catalog import query
from abacarium.plans.tables import DECLARED, Tables
from abacarium.session import scratch_path
from abacarium.sources.snapshots import SnapshotTable
from abacarium.streaming.changes import current_rows, stream_changes
from abacarium.streaming.feeds import dedupe_bounded, read_feed, stream_facts, stream_merge

_FILES_PER_BATCH = 2
_TRACKED = ["o_orderpriority", "o_orderstatus"]
_NEWER = ["o_orderdate", "o_orderkey"]
_DIMENSION = (
    "o_custkey bigint, o_orderpriority string, o_orderstatus string, o_orderdate timestamp_ntz, o_orderkey bigint, "
    "is_active boolean, created_at timestamp, updated_at timestamp")


def _feed(df: DataFrame, day: str) -> DataFrame:
    """Land the rows as files by year and stream a fixed number of files per batch."""
    path = scratch_path(df.sparkSession, "feed")
    df.withColumn("feed_year", F.year(day)).hint("rebalance", "feed_year").write.partitionBy("feed_year").parquet(path)
    return read_feed(df.sparkSession, path, df.schema, _FILES_PER_BATCH).select(*df.columns)


@query("stream_merge_dim", """
SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderkey FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def stream_merge_dim(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", *_TRACKED, *_NEWER)
    table = SnapshotTable(t.spark, scratch_path(t.spark, "dimension"), StructType.fromDDL(_DIMENSION))
    stream = stream_merge(
        _feed(rows, "o_orderdate"), table, "o_custkey", _TRACKED, _NEWER, scratch_path(t.spark, "progress"), dt.datetime(2002, 1, 1))
    stream.awaitTermination()
    return table.read().select("o_custkey", *_TRACKED, "o_orderkey")


@query("stream_changes", """
SELECT o_custkey, o_orderpriority, o_orderstatus, true AS counted FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def stream_changed(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", *_TRACKED, F.to_date("o_orderdate").alias("day"), "o_orderkey")
    path = scratch_path(t.spark, "changes")
    stream_changes(_feed(rows, "day"), path, "o_custkey", _TRACKED, ["day", "o_orderkey"], scratch_path(t.spark, "progress")).awaitTermination()
    changes = t.spark.read.parquet(path)
    # Versions count the changes of a key, without a gap.
    versions = changes.groupBy("o_custkey").agg((F.max("version") == F.count(F.lit(1))).alias("counted"))
    return current_rows(changes, "o_custkey").select("o_custkey", *_TRACKED).join(versions, "o_custkey")


@query("stream_fact", """
SELECT DISTINCT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
       CASE WHEN strftime(l_shipdate, '%Y-%m') BETWEEN '1996-01' AND '1996-12'
            THEN strftime(l_shipdate, '%Y-%m') ELSE 'default' END AS order_month FROM lineitem""")
def stream_fact(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
    rows = t.lineitem.select(*columns)
    path = scratch_path(t.spark, "fact")
    stream = stream_facts(
        _feed(rows, "l_shipdate"), path, ["l_orderkey", "l_linenumber", "l_shipdate"], "l_shipdate", DECLARED,
        scratch_path(t.spark, "progress"))
    stream.awaitTermination()
    fact = t.spark.read.schema(rows.withColumn("order_month", partition_of("l_shipdate", DECLARED)).schema).parquet(path)
    return fact.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"), "order_month")


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    # Every event arrives twice, in one file or in two; the delay covers the whole feed.
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    feed = _feed(rows.unionByName(rows), "at").withColumn("at", F.col("at").cast("timestamp"))
    path = scratch_path(t.spark, "deduped")
    dedupe_bounded(feed, ["event_id"], "at", "5000 days").writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", scratch_path(t.spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(path).select("event_id", "user_id", "event_type")
