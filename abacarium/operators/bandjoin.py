"""Labels from a table of bands, by an equi-join on bins.

A chain of CASE branches serves a few fixed bands. A table of thousands needs a join on
a range, which Spark runs as a nested loop unless there is something to hash. Here the
range of all bounds is cut into as many bins as there are bands; a band goes into each
bin that it touches, a value into its own, and only they are compared. Bands that do not
overlap fill no more than twice as many places as there are bands, whatever their widths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def band_join(values: DataFrame, value: str, bands: DataFrame, low: str = "low", high: str = "high", labels: Sequence[str] = ("label",)) -> DataFrame:
    """``values`` with the ``labels`` of the band ``low <= value < high``, NULL where there is none.

    A NULL bound is open. A value in several bands gives a row for each; a NULL value and
    one in a gap have no band. Bounds and values are compared as doubles.
    """
    edges = bands.select(F.col(low).cast("double").alias("_low"), F.col(high).cast("double").alias("_high"), *labels)
    edges = edges.where("_low IS NULL OR _high IS NULL OR _low < _high")
    # Three numbers for the driver.
    size = edges.agg(F.count(F.lit(1)), F.least(F.min("_low"), F.min("_high")), F.greatest(F.max("_low"), F.max("_high"))).first()
    count, first, last = size[0], size[1], size[2]
    first = 0.0 if first is None else first
    width = ((last if last is not None else first) - first) / max(count, 1) or 1.0

    def bin_of(x: Column) -> Column:
        place = F.floor((x - F.lit(first)) / F.lit(width))
        # least() and greatest() pass over NULL, which here is an open bound.
        return F.when(x.isNotNull(), F.least(F.greatest(place, F.lit(-1)), F.lit(count + 1))).cast("long")

    spread = edges.withColumn("_bin", F.explode(F.sequence(
        F.coalesce(bin_of(F.col("_low")), F.lit(-1).cast("long")), F.coalesce(bin_of(F.col("_high")), F.lit(count + 1).cast("long")))))
    place = F.col(value).cast("double")
    known = values.where(place.isNotNull()).withColumns({"_value": place, "_at": bin_of(place)})
    inside = (F.col("_low").isNull() | (F.col("_value") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("_value") < F.col("_high")))
    joined = known.join(spread, (F.col("_at") == F.col("_bin")) & inside, "left").select(*values.columns, *labels)
    # Rows without a value stay out of the join, where they would meet in one task.
    return joined.unionByName(values.where(place.isNull()), allowMissingColumns=True)
