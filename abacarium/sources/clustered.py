"""Parquet laid out for point lookups: ranges of a key per file, Bloom filters for other columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str], bloom: Sequence[str] = (), files: int | None = None, group_bytes: int = 8 << 20,
                    distinct: int = 1_000_000) -> str:
    """Write ``df`` sorted by ``cluster`` over files of separate ranges, in small row groups.

    Minima and maxima then tell nearly all files and row groups that cannot hold a key.
    Columns in ``bloom``, which are in no order, get a Bloom filter for ``distinct`` values
    a row group. Dictionaries are off for them, since Parquet writes a filter only then.
    """
    ranged = df.repartitionByRange(*([files] if files else []), *cluster).sortWithinPartitions(*cluster)
    writer = ranged.write.mode("overwrite").option("parquet.block.size", group_bytes)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct).option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)
    return path


def rows_scanned(df: DataFrame) -> int:
    """How many rows the scans of ``df`` give, after files, row groups and pages were skipped; runs the query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.executedPlan().collectLeaves() if plan.nodeName().startswith("Adaptive") else plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numOutputRows"))


def clustered_lookup(spark: SparkSession, path: str, **wanted) -> DataFrame:
    """The rows whose columns have the wanted values."""
    found = spark.read.parquet(path)
    for column, value in wanted.items():
        found = found.where(found[column] == value)
    return found
