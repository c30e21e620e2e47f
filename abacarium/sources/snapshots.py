"""Tables that are replaced as a whole, without ever overwriting what is being read.

A version is written to a new folder; then one row is appended to a small log,
whose highest version is the current one. A failed write leaves no log row, and
readers of the old version are not disturbed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from abacarium.session import discard, read_if_there

_LOG = "version long, batch long"


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keep: int = 2):
        """``keep`` versions stay, so that whoever still reads the one before is not disturbed."""
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep

    def _log(self) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.path}/log", _LOG)

    def state(self) -> tuple[int, int]:
        """The current version and the last batch it holds; (0, -1) for a new table."""
        log = self._log()
        if log is None:
            return 0, -1
        row = log.agg(F.max("version"), F.max("batch")).first()
        return row[0] or 0, -1 if row[1] is None else row[1]

    def read(self) -> DataFrame:
        version, _ = self.state()
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def replace(self, rows: DataFrame, batch: int | None = None) -> int:
        """Write the next version and make it current."""
        version = self.state()[0] + 1
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/v={version}")
        entry = self.spark.createDataFrame([(version, batch)], _LOG)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        if version > self.keep:
            discard(self.spark, f"{self.path}/v={version - self.keep}")
        return version
