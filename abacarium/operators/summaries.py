"""A summary per month that is kept up by deltas instead of full runs.

Revenue and units could be added up from signed deltas alone, distinct orders could not:
whether an order still counts depends on its other lines. So a detail table keeps, per
month, group and order, the number of its lines with their sums, and a delta of signed
rows is added to it. Only months that a delta touches are read and written. New versions
of them are written to a new folder; one row per month in a small log makes them current,
so a broken run leaves the old state, and a batch that comes again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from abacarium.session import read_if_there, scratch_path

_LOG = "version long, batch long, month string"


def signed_delta(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """One delta of inserted (``sign`` 1) and deleted rows (-1); an update is both."""
    parts = [df.withColumn("sign", F.lit(sign).cast("long")) for df, sign in ((inserted, 1), (deleted, -1)) if df is not None]
    return reduce(DataFrame.unionByName, parts)


class MonthlySummary:
    """Sums and distinct orders per month and group at ``path``.

    ``groups``: typed as in the rows, for example ``{"category": "string"}``. ``order``: the
    column whose distinct values are counted. ``sums``: columns that are added up, whole numbers.
    """

    def __init__(self, spark: SparkSession, path: str, groups: dict[str, str], order: tuple[str, str], sums: Sequence[str], month: str = "month"):
        self.spark, self.path, self.month = spark, path.rstrip("/"), month
        self.groups, self.order, self.sums = list(groups), order[0], list(sums)
        named = [f"`{n}` {t}" for n, t in groups.items()]
        added = [f"`{s}` long" for s in sums]
        self._detail = StructType.fromDDL(", ".join([*named, f"`{order[0]}` {order[1]}", "lines long", *added, "version long", f"`{month}` string"]))
        self._summary = StructType.fromDDL(", ".join([*named, "orders long", *added, "version long", f"`{month}` string"]))

    def _log(self) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.path}/log", _LOG)

    def versions(self) -> dict[str, int]:
        """The current version of each month; one row per month comes to the driver."""
        log = self._log()
        return {} if log is None else {r["month"]: r["version"] for r in log.where("month IS NOT NULL").groupBy("month").agg(F.max("version").alias("version")).collect()}

    def _current(self, kind: str, schema: StructType, months: Sequence[str] | None) -> DataFrame:
        current = {m: v for m, v in self.versions().items() if months is None or m in months}
        if not current:
            return self.spark.createDataFrame([], schema)
        by_version: dict[int, list[str]] = {}
        for name, version in current.items():
            by_version.setdefault(version, []).append(name)
        wanted: list[Column] = [(F.col("version") == v) & F.col(self.month).isin(*names) for v, names in by_version.items()]
        # Both are partition columns, so only the files of current versions are read.
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}").where(reduce(Column.__or__, wanted))

    def detail(self, months: Sequence[str] | None = None) -> DataFrame:
        return self._current("detail", self._detail, months).drop("version")

    def read(self, months: Sequence[str] | None = None) -> DataFrame:
        """The summary: month, groups, ``orders`` and the sums; of all months or of some."""
        return self._current("summary", self._summary, months).drop("version")

    def apply(self, delta: DataFrame, batch: int) -> list[str]:
        """Add a delta (``month``, groups, order, sums, ``sign``); returns the months that were touched.

        Batches are numbered upwards; one that is not above the last is skipped. Rows
        deleted more often than they were inserted are an error, and then nothing changes.
        """
        log = self._log()
        last = None if log is None else log.agg(F.max(F.struct("batch", "version"))).first()[0]
        if last is not None and batch <= last["batch"]:
            return []
        version = 1 + (0 if log is None else log.agg(F.max("version")).first()[0])
        keys = [self.month, *self.groups, self.order]
        staged = scratch_path(self.spark, "delta")
        changes = delta.groupBy(*keys).agg(F.sum("sign").alias("lines"), *[F.sum(F.col("sign") * F.col(s)).alias(s) for s in self.sums])
        changes.where(reduce(Column.__or__, [F.col(c) != 0 for c in ("lines", *self.sums)])).write.parquet(staged)
        changes = self.spark.read.parquet(staged)
        months = sorted(r[0] for r in changes.select(self.month).distinct().collect())
        columns = [*keys, "lines", *self.sums]
        both = self.detail(months).select(*columns).unionByName(changes.select(*columns))
        after = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("lines", *self.sums)]).where(reduce(Column.__or__, [F.col(c) != 0 for c in ("lines", *self.sums)]))
        place = f"{self.path}/detail/version={version}"
        # Few files a month, yet a large month is split between tasks.
        after.hint("rebalance", self.month).write.mode("overwrite").partitionBy(self.month).parquet(place)
        fresh = self.spark.read.schema(StructType([f for f in self._detail.fields if f.name != "version"])).parquet(place)
        if not fresh.where("lines <= 0").isEmpty():
            raise ValueError("the delta deletes rows that are not there")
        counts = fresh.groupBy(self.month, *self.groups).agg(F.count(F.lit(1)).alias("orders"), *[F.sum(s).alias(s) for s in self.sums])
        counts.hint("rebalance", self.month).write.mode("overwrite").partitionBy(self.month).parquet(f"{self.path}/summary/version={version}")
        entries = [(version, batch, m) for m in months] or [(version, batch, None)]
        self.spark.createDataFrame(entries, _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return months
