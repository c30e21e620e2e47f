"""CSV loads that survive bad lines: good rows, and rejects with file and line number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from abacarium.operators.ordering import join_null_safe
from abacarium.session import stored

_BAD = "_bad"


class TooManyBadLines(ValueError):
    """More lines could not be read than the load allows."""


def load_tolerant(
    spark: SparkSession, path: str, schema: StructType, most_bad: int | None = None, options: dict[str, str] | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files that fit ``schema``, and the lines that do not: ``file``, ``line_no`` (from 1), ``line``.

    A line is bad if it has another number of fields or a value that its type cannot
    hold. Blank lines are neither. Good and bad lines and headers add up to the lines of
    the files. More than ``most_bad`` bad lines raise an error that names some. Lines are
    parsed one by one, so that each has its number; a quoted value cannot span lines.
    The lines of a large file are numbered by their places in its splits, whose sizes (a
    row per split) are added up.
    """
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    # Stored first: places belong to this scan's splits.
    lines = stored(text, "lines")
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    earlier = splits.alias("s").join(splits.alias("e"), (F.col("s.file") == F.col("e.file")) & (F.col("e.block") < F.col("s.block")), "left").groupBy(
        F.col("s.file").alias("file"), F.col("s.block").alias("block"), F.col("s.first").alias("first")).agg(F.coalesce(F.sum("e.size"), F.lit(0)).alias("before"))
    numbered = join_null_safe(lines, earlier, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "value")
    if header:
        numbered = numbered.where("line_no > 1")
    parsed = StructType([StructField(f.name, f.dataType, True) for f in schema.fields]).add(_BAD, StringType())
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, **(options or {})}
    read = numbered.where(F.trim("value") != "").withColumn("row", F.from_csv("value", parsed.simpleString(), settings))
    read = stored(read, "read")
    rejects = read.where(F.col(f"row.{_BAD}").isNotNull()).select("file", "line_no", F.col("value").alias("line"))
    if most_bad is not None:
        bad = rejects.count()
        if bad > most_bad:
            some = ", ".join(f"{r['file'].rsplit('/', 1)[-1]}:{r['line_no']}" for r in rejects.limit(5).collect())
            raise TooManyBadLines(f"{bad} bad lines, {most_bad} allowed; for example {some}")
    return read.where(F.col(f"row.{_BAD}").isNull()).select(*[F.col(f"row.`{f.name}`") for f in schema.fields]), rejects


def bulk_load_tolerant(
    spark: SparkSession, source: str, schema: StructType, staging: str, rejected: str, most_bad: int | None = None, options: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Replace the staging table by the good rows, and the table at ``rejected`` by the bad lines; neither if there are too many."""
    good, bad = load_tolerant(spark, source, schema, most_bad, options)
    good.write.mode("overwrite").parquet(staging)
    bad.write.mode("overwrite").parquet(rejected)
    return spark.read.schema(good.schema).parquet(staging), spark.read.schema(bad.schema).parquet(rejected)
