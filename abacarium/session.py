"""Session settings and the shared scratch folder.

Operators that must read one intermediate result twice with the same physical
layout write it once to the scratch folder. That cuts lineage and survives the
loss of executors, because the folder is the shared one that the cluster names
in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "abacarium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI mode, UTC time and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Only a local session without a checkpoint folder gets one of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="abacarium-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet; the table read back, columns prunable, and its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back, columns prunable."""
    return stored_at(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing was written there."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        found = reader.parquet(path)
        found.schema  # noqa: B018  (resolves the path now)
        return found
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
