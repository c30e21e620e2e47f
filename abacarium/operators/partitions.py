"""Single partitions of a partitioned table: replaced, archived, with the others left as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from abacarium.session import discard, stored_at


def replace_partitions(spark: SparkSession, rows: DataFrame, path: str, partition: str) -> DataFrame:
    """Replace the partitions that occur in ``rows`` by them, and return the table at ``path``.

    The rows are staged first, since they may come from the partitions that go. No row
    for a partition leaves it alone; repeating the call changes nothing more.
    """
    staged, place = stored_at(rows, "replacement")
    staged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    discard(spark, place)
    return spark.read.schema(rows.schema).parquet(path)


def archive_partitions(spark: SparkSession, path: str, schema, partition: str, values: Sequence[str], archive: str) -> tuple[DataFrame, DataFrame]:
    """Move partitions to the table at ``archive``; returns what is left, and the archive.

    The copy is checked by its number of rows before the partitions are removed. A run
    that was broken off can be repeated: the copy replaces what it left.
    """
    gone = spark.read.schema(schema).parquet(path).where(F.col(partition).isin(*values))
    rows = gone.count()
    if rows:
        gone.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(archive)
        kept = spark.read.schema(schema).parquet(archive).where(F.col(partition).isin(*values)).count()
        if kept != rows:
            raise RuntimeError(f"{kept} of {rows} rows are in the archive; nothing was removed")
        for value in values:
            discard(spark, f"{path}/{partition}={value}")
    return spark.read.schema(schema).parquet(path), spark.read.schema(schema).parquet(archive)


def partition_files(table: DataFrame, partition: str) -> DataFrame:
    """``partition``, ``file`` and its time of change for every file that holds rows."""
    return table.select(F.col(partition), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("changed")).distinct()
