"""CSV scans and sinks, staging loads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def scan_csv(
    spark: SparkSession, path: str, schema: StructType, timestamp_format: str | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV files with a header and a declared schema (nothing is inferred)."""
    reader = spark.read.schema(schema).option("header", True).option("mode", mode)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def sink_csv(df: DataFrame, path: str, timestamp_format: str | None = None) -> str:
    """Write CSV files with a header below ``path``; parent folders are created."""
    writer = df.write.mode("overwrite").option("header", True)
    if timestamp_format:
        writer = writer.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    writer.csv(path)
    return path


def bulk_load(spark: SparkSession, source: str, schema: StructType, staging: str) -> DataFrame:
    """Replace the staging table at ``staging`` by the CSV files at ``source`` (truncate and reload)."""
    scan_csv(spark, source, schema).select(*schema.fieldNames()).write.mode("overwrite").parquet(staging)
    return spark.read.schema(schema).parquet(staging)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
              for name, df in tables.items()]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out
