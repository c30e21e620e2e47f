"""Streams end like the batch form, whatever the order of the files, and replays change nothing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from abacarium.operators.facts import MonthRange
from abacarium.schemas import table
from abacarium.session import scratch_path
from abacarium.sources.snapshots import SnapshotTable
from abacarium.streaming.changes import changed_rows, current_rows, stream_changes
from abacarium.streaming.feeds import dedupe_bounded, read_feed, stream_facts, stream_merge

FEED = table("id int?, city string?, day date?")
DIMENSION = table("id int?, city string?, day date?, is_active bool?, created_at time?, updated_at time?")
STORE = "spark.sql.streaming.stateStore.providerClass"
DAY = [dt.date(2026, 7, d) for d in range(1, 5)]


def _drop(spark, path, rows, schema=FEED):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_dimension_stream(spark):
    feed, progress = scratch_path(spark, "feed"), scratch_path(spark, "progress")
    dimension = SnapshotTable(spark, scratch_path(spark, "dim"), DIMENSION)

    def run():
        stream = stream_merge(read_feed(spark, feed, FEED), dimension, "id", ["city"], ["day"], progress, dt.datetime(2026, 7, 9))
        stream.awaitTermination()
        return {r["id"]: (r["city"], r["day"]) for r in dimension.read().collect()}

    _drop(spark, feed, [(1, "B", DAY[1]), (2, "B", DAY[1]), (2, "A", DAY[0])])
    assert run() == {1: ("B", DAY[1]), 2: ("B", DAY[1])}
    _drop(spark, feed, [(1, "A", DAY[0]), (3, "C", DAY[2])])  # an older row comes late
    assert run() == {1: ("B", DAY[1]), 2: ("B", DAY[1]), 3: ("C", DAY[2])}
    _drop(spark, feed, [(1, "B", DAY[3])])  # newer, same city: only the age moves
    _drop(spark, feed, [(1, "Z", DAY[2])])
    assert run()[1] == ("B", DAY[3])
    version = dimension.state()
    assert run()[1] == ("B", DAY[3]) and dimension.state() == version


def test_changes_of_a_dimension(spark):
    feed, progress, path = (scratch_path(spark, name) for name in ("feed", "progress", "changes"))
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)

    def run():
        stream = stream_changes(read_feed(spark, feed, FEED), path, "id", ["city"], ["day"], progress)
        stream.awaitTermination()
        written = sum(p["numInputRows"] > 0 for p in stream.recentProgress)
        updates = sum(op["numRowsUpdated"] for p in stream.recentProgress for op in p["stateOperators"])
        rows = spark.read.parquet(path)
        return {r["id"]: (r["city"], r["version"]) for r in current_rows(rows, "id").collect()}, rows.count(), written, updates

    _drop(spark, feed, [(i, "A", DAY[0]) for i in range(200)] + [(1, "B", DAY[1]), (1, "A", DAY[0]), (None, "X", DAY[0])])
    now, rows, _, _ = run()
    assert len(now) == 200 and rows == 200 and now[1] == ("B", 1) and now[7] == ("A", 1)
    # After a restart the state is there: a change, a late row, a newer row without a change, a repeated one.
    _drop(spark, feed, [(2, "C", DAY[1]), (1, "Z", DAY[0]), (3, "A", DAY[2]), (4, "A", DAY[0]), (5, None, DAY[1])])
    now, rows, batches, updates = run()
    assert batches == 1 and rows == 202 and updates <= 5, "a batch costs what it brings"
    assert now[2] == ("C", 2) and now[1] == ("B", 1) and now[3] == ("A", 1) and now[5] == (None, 2)
    _drop(spark, feed, [(3, "D", DAY[1]), (2, "C", DAY[3])])  # older than the newer row of 3, which gave no output
    now, rows, _, _ = run()
    assert rows == 202 and now[3] == ("A", 1) and now[2] == ("C", 2)
    assert run()[:2] == (now, rows)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == store


def test_keys_share_calls_to_the_state(spark):
    schema = StructType.fromDDL("id double, city string, day date, at timestamp")
    feed, progress, path = (scratch_path(spark, name) for name in ("feed", "progress", "changes"))

    def run():
        rows = changed_rows(read_feed(spark, feed, schema), "id", ["city"], ["day", "at"], buckets=8)
        stream = rows.writeStream.format("parquet").option("path", path).option(
            "checkpointLocation", progress).trigger(availableNow=True).start()
        stream.awaitTermination()
        return sum(op["numRowsUpdated"] for p in stream.recentProgress for op in p["stateOperators"])

    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        nan, at = float("nan"), dt.datetime(2026, 7, 1, 5)
        _drop(spark, feed, [(float(i), "A", DAY[0], None) for i in range(300)] + [(nan, "A", DAY[0], at), (nan, "B", DAY[1], at), (None, "X", DAY[3], at)], schema)
        assert run() <= 8, "one update for a bucket, not for a key"
        _drop(spark, feed, [(float(i), "A" if i % 2 else None, DAY[1], at) for i in range(100)] + [(nan, "C", DAY[1], None), (-0.0, "Z", DAY[0], at)], schema)
        assert run() <= 8
        _drop(spark, feed, [(float(i), "B", DAY[0], at) for i in range(300)] + [(nan, "C", DAY[2], None)], schema)
        assert run() <= 8
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
    now = {str(r["id"]): (r["city"], r["version"], r["at"]) for r in current_rows(spark.read.parquet(path), "id").collect()}
    assert len(now) == 301 and now["nan"] == ("C", 2, None)
    # Z for -0.0, a late row of 0, changes nothing; B of the first day is newer than A without a time.
    assert now["0.0"] == (None, 2, at) and now["1.0"] == ("A", 1, None) and now["200.0"] == ("B", 2, at)


def test_fact_stream(spark):
    schema = table("order_id int?, order_date date?, amount int?")
    feed, progress, path = (scratch_path(spark, name) for name in ("feed", "progress", "fact"))
    late = dt.date(2027, 1, 15)
    _drop(spark, feed, [(1, DAY[0], 5), (1, DAY[0], 5), (2, late, 7)], schema)
    _drop(spark, feed, [(1, DAY[0], 9), (3, DAY[1], 1)], schema)
    for _ in range(2):
        stream_facts(read_feed(spark, feed, schema), path, ["order_id", "order_date"], "order_date",
                     MonthRange("2026-07", "2026-11"), progress).awaitTermination()
    rows = spark.read.parquet(path).orderBy("order_id").collect()
    assert [(r["order_id"], r["order_month"]) for r in rows] == [(1, "2026-07"), (2, "default"), (3, "2026-07")]


def test_bounded_dedupe(spark):
    schema = table("id int?, ts time?")
    feed = scratch_path(spark, "feed")
    at = dt.datetime(2026, 7, 1)
    _drop(spark, feed, [(1, at), (1, at), (2, at)], schema)
    stream = dedupe_bounded(read_feed(spark, feed, schema), ["id"], "ts", "1 hour")
    run = (stream.writeStream.format("memory").queryName("deduped").option(
        "checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start())
    run.awaitTermination()
    assert spark.table("deduped").where(F.col("id") == 1).count() == 1
