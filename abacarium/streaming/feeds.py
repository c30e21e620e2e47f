"""Streams of feed files into a dimension and into a fact table.

Both give the same table as the batch operator over all files, and a batch that
is delivered again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from abacarium.operators.facts import MonthRange, insert_if_absent, route
from abacarium.operators.merge import merge_dimension
from abacarium.session import discard, stored_at
from abacarium.sources.snapshots import SnapshotTable


def read_feed(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """A stream over the Parquet files that arrive below ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_merge(
    feed: DataFrame, table: SnapshotTable, key: str, tracked: Sequence[str], newer: Sequence[str],
    checkpoint: str, as_of: dt.datetime,
) -> StreamingQuery:
    """Merge each arriving batch into the dimension; older feed rows never overwrite newer ones."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= table.state()[1]:
            return  # already merged before a restart
        merged = merge_dimension(table.read(), batch, key, tracked, as_of, latest=newer, newer=newer)
        table.replace(merged.drop("action"), batch_id)

    return (
        feed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_facts(
    feed: DataFrame, path: str, keys: Sequence[str], day: str, declared: MonthRange, checkpoint: str,
    partition: str = "order_month",
) -> StreamingQuery:
    """Append the new keys of each arriving batch to the partitioned fact table."""

    def insert(batch: DataFrame, batch_id: int) -> None:
        # Staged once: the insert looks at its batch more than once.
        staged, place = stored_at(route(batch, day, declared, partition), "batch")
        insert_if_absent(batch.sparkSession, staged, path, keys, partition)
        discard(batch.sparkSession, place)

    return (
        feed.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def dedupe_bounded(feed: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other, with bounded state."""
    return feed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
