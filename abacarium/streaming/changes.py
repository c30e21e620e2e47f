"""A dimension feed as a stream of changes, with the current rows in keyed state.

``stream_merge`` writes the whole dimension with every batch. Here each key's row lives
in a RocksDB state store, partitioned by buckets of keys and checkpointed with the stream;
a batch reads and writes the buckets of its own keys and gives the rows that really changed.
They are appended as files, so a small batch costs what it brings and the keys that share
its buckets (one in ``BUCKETS`` of the dimension for each), and a large one never more than
its rows and the dimension, in a bounded number of calls to the store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: State is kept by this many parts of the keys; a checkpoint keeps the number it began with.
BUCKETS = 1 << 15


class _Latest(StatefulProcessor):
    """Keeps the newest row of each key of a bucket; gives it if its tracked columns are other than before.

    The state has one list per column. A call to the store costs far more than a row, so that
    keys share one: a bucket is read once and, if a row of it changed, written once per batch.
    """

    def __init__(self, key: str, tracked: list[str], newer: list[str], state: StructType):
        self.key, self.tracked, self.newer, self.state = key, tracked, newer, state

    def init(self, handle) -> None:
        self.kept = handle.getValueState("rows", self.state)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        names = self.tracked + self.newer
        aged, width = [names.index(c) for c in self.newer + self.tracked], len(self.tracked)

        def ident(value):
            # NaN is one key, though not equal to itself.
            return value if value == value else "NaN"

        def age(values):
            # NULL is the oldest; the tracked columns break ties, so that files may come in any order.
            return [(True, values[i]) if values[i] is not None else (False,) for i in aged]

        best = {}
        for row in rows:
            values = [row[c] for c in names]
            name, years = ident(row[self.key]), age(values)
            if name not in best or years > best[name][0]:
                best[name] = years, values, row[self.key]
        columns = self.kept.get()
        known = {} if columns is None else {ident(kept[0]): kept for kept in zip(*columns, strict=True)}
        written = False
        for name, (years, values, value) in best.items():
            old = known.get(name)
            if old is not None and years <= age(old[1:-1]):
                continue
            changed = old is None or any(a != b for a, b in zip(values[:width], old[1:1 + width], strict=True))
            version = (0 if old is None else old[-1]) + changed
            known[name], written = (value, *values, version), True
            if changed:
                yield Row(**{self.key: value, **dict(zip(names, values, strict=True)), "version": version,
                             "action": "INSERT" if old is None else "UPDATE"})
        if written:
            self.kept.update(tuple(list(column) for column in zip(*known.values(), strict=True)))

    def close(self) -> None:
        pass


def changed_rows(feed: DataFrame, key: str, tracked: Sequence[str], newer: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The stream of changes of a feed: ``key``, ``tracked``, ``newer``, ``version`` (1, 2, ... per key), ``action``.

    A row counts if it is newer by ``newer`` than what the key has, and is given if a
    tracked column differs, NULL being a value like any other. Of several rows of a key
    in a batch the newest counts. Rows without a key are left out.
    """
    kinds = {f.name: f.dataType for f in feed.schema.fields}
    names = [*tracked, *[c for c in newer if c not in tracked]]
    later = [c for c in newer if c not in tracked]
    fields = [StructField(c, kinds[c], True) for c in (key, *names)] + [StructField("version", LongType(), True)]
    state = StructType([StructField(f.name, ArrayType(f.dataType), True) for f in fields])
    out = StructType([*fields, StructField("action", StringType(), True)])
    rows = feed.where(F.col(key).isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket"), key, *names)
    return rows.groupBy("_bucket").transformWithState(_Latest(key, list(tracked), later, state), out, "Append", "None")


def stream_changes(feed: DataFrame, path: str, key: str, tracked: Sequence[str], newer: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Append the changes of each arriving batch to the files at ``path``, exactly once."""
    conf = feed.sparkSession.conf
    before = conf.get(_STORE, None)
    conf.set(_STORE, _ROCKS)
    try:
        # A stream takes the settings along when it starts.
        return changed_rows(feed, key, tracked, newer).writeStream.format("parquet").option("path", path).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            conf.unset(_STORE)
        else:
            conf.set(_STORE, before)


def current_rows(changes: DataFrame, key: str) -> DataFrame:
    """The dimension after all changes: the last version of each key, by an aggregate."""
    rest = [c for c in changes.columns if c not in (key, "action")]
    return changes.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("row")).select(key, "row.*")
