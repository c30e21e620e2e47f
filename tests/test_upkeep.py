"""Collated text, summaries by deltas, single partitions, sketches, bands, bad lines, clustered files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F
from pyspark.sql.types import StructType

from abacarium.operators.bandjoin import band_join
from abacarium.operators.collated import ACCENTLESS, CASELESS, read_collated, with_collation
from abacarium.operators.partitions import archive_partitions, partition_files, replace_partitions
from abacarium.operators.sketches import sketch_table, united
from abacarium.operators.summaries import MonthlySummary, signed_delta
from abacarium.schemas import table
from abacarium.session import scratch_path
from abacarium.sources.clustered import clustered_lookup, rows_scanned, write_clustered
from abacarium.sources.dirty import TooManyBadLines, bulk_load_tolerant, load_tolerant


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Collations.

def test_joins_groups_and_predicates_ignore_case_by_type(spark):
    left = with_collation(spark.createDataFrame([(1, "Delhi"), (2, "DELHI"), (3, "pune"), (4, None)], "id int, city string"))
    right = with_collation(spark.createDataFrame([("delhi", "n"), ("PUNE", "w"), ("Goa", "w"), (None, "x")], "name string, zone string"))
    joined = left.join(right, left["city"] == right["name"])
    distinct, grouped = left.select("city").distinct(), left.groupBy("city").count()
    assert sorted(r["id"] for r in joined.collect()) == [1, 2, 3]
    assert distinct.count() == 3 and sorted(r["count"] for r in grouped.collect()) == [1, 1, 2]
    assert left.where("city = 'dElHi'").count() == 2 and left.where("city LIKE 'del%'").count() == 2
    assert left.where(F.col("city").isin("PuNe")).count() == 1
    for df in (joined, distinct, grouped):
        assert "lower(" not in _plan(df)
    assert "CartesianProduct" not in _plan(joined) and "NestedLoop" not in _plan(joined)
    numbered = left.withColumn("no", F.row_number().over(Window.partitionBy("city").orderBy("id")))
    assert {r["id"]: r["no"] for r in numbered.collect()} == {1: 1, 2: 2, 3: 1, 4: 1}
    assert [r["id"] for r in left.orderBy(F.desc_nulls_last("city"), "id").collect()] == [3, 1, 2, 4]


def test_accents_and_files_that_know_no_collation(spark):
    names = [("José",), ("JOSE",), ("josé ",), ("Zoe",)]
    path = scratch_path(spark, "names")
    spark.createDataFrame(names, "name string").write.parquet(path)
    plain = StructType.fromDDL("name string")
    assert read_collated(spark, path, plain, ACCENTLESS).where("name = 'jose'").count() == 2
    assert read_collated(spark, path, plain, CASELESS).where("name = 'jose'").count() == 1
    kept = scratch_path(spark, "kept")
    read_collated(spark, path, plain, ACCENTLESS).write.parquet(kept)
    assert spark.read.parquet(kept).select("name").distinct().count() == 3
    back = with_collation(spark.read.parquet(kept), "UTF8_BINARY")
    assert back.distinct().count() == 4
    with pytest.raises(ValueError, match="no such columns"):
        with_collation(back, columns=["nobody"])


# Summaries by deltas.

def _summary(spark):
    return MonthlySummary(spark, scratch_path(spark, "summary"), {"category": "string"}, ("order_id", "bigint"), ["cents"])


_SALES = "month string, category string, order_id bigint, cents bigint"


def _full(rows):
    out = {}
    for month, category, order, cents in rows:
        orders, total = out.setdefault((month, category), (set(), [0]))
        orders.add(order)
        total[0] += cents
    return {k: (len(o), c[0]) for k, (o, c) in out.items()}


def _read(table, months=None):
    return {(r["month"], r["category"]): (r["orders"], r["cents"]) for r in table.read(months).collect()}


def test_deltas_give_what_a_full_run_gives(spark):
    rng, table = random.Random(1), _summary(spark)
    rows = []
    for batch in range(1, 6):
        inserted = [(f"2026-0{rng.randint(1, 4)}", rng.choice(["a", "b", None]), rng.randint(1, 12), rng.randint(-5, 50)) for _ in range(30)]
        deleted = rng.sample(rows, len(rows) // 4)
        for row in deleted:
            rows.remove(row)
        rows += inserted
        table.apply(signed_delta(spark.createDataFrame(inserted, _SALES), spark.createDataFrame(deleted, _SALES)), batch)
        assert _read(table) == _full(rows)


def test_a_delta_reads_and_writes_touched_months_alone(spark):
    table = _summary(spark)
    rows = [(f"2026-{m:02d}", "a", m * 10 + o, 5) for m in range(1, 7) for o in range(4)]
    table.apply(signed_delta(spark.createDataFrame(rows, _SALES)), 1)
    files = {f: None for f in table.read().inputFiles()}
    assert table.apply(signed_delta(spark.createDataFrame([("2026-02", "a", 99, 7)], _SALES)), 2) == ["2026-02"]
    current = table.detail(["2026-02"])
    assert len(current.inputFiles()) > 0 and "PartitionFilters: [" in _plan(current)
    scan = [line for line in _plan(table.read(["2026-02"])).splitlines() if "FileScan" in line][0]
    assert "version" in scan.split("PartitionFilters")[1] and "2026-02" in scan.split("PartitionFilters")[1]
    after = set(table.read().inputFiles())
    assert len(set(files) & after) >= 5 and table.versions() == {**{f"2026-{m:02d}": 1 for m in range(1, 7)}, "2026-02": 2}
    # A batch that comes again, a month that empties, a delete of nothing.
    assert table.apply(signed_delta(spark.createDataFrame([("2026-02", "a", 99, 7)], _SALES)), 2) == []
    table.apply(signed_delta(deleted=spark.createDataFrame([r for r in rows if r[0] == "2026-05"], _SALES)), 3)
    assert ("2026-05", "a") not in _read(table) and _read(table)["2026-02", "a"] == (5, 27)
    before = _read(table)
    with pytest.raises(ValueError, match="not there"):
        table.apply(signed_delta(deleted=spark.createDataFrame([("2026-01", "a", 12345, 1)], _SALES)), 4)
    assert _read(table) == before
    table.apply(signed_delta(spark.createDataFrame([("2026-01", "b", 1, 1)], _SALES)), 4)
    assert _read(table)["2026-01", "b"] == (1, 1)


# Single partitions.

def _months(spark):
    path = scratch_path(spark, "fact")
    rows = spark.createDataFrame([(i, f"2026-0{1 + i % 3}") for i in range(30)], "id int, month string")
    rows.write.partitionBy("month").parquet(path)
    return rows, path


def _files(spark, path, schema):
    found = partition_files(spark.read.schema(schema).parquet(path), "month").collect()
    return {r["month"]: {(r["file"], r["changed"]) for r in found if r["month"] == m} for m in {r["month"] for r in found} for r in found if r["month"] == m}


def test_one_month_is_replaced(spark):
    rows, path = _months(spark)
    before = _files(spark, path, rows.schema)
    fact = spark.read.schema(rows.schema).parquet(path)
    for _ in range(2):
        after = replace_partitions(spark, fact.where("month = '2026-02' AND id > 10"), path, "month")
        assert after.where("month = '2026-02'").count() == 6 and after.count() == 26
        now = _files(spark, path, rows.schema)
        assert now["2026-01"] == before["2026-01"] and now["2026-03"] == before["2026-03"] and not now["2026-02"] & before["2026-02"]
        fact = spark.read.schema(rows.schema).parquet(path)
    assert replace_partitions(spark, fact.limit(0), path, "month").count() == 26


def test_months_are_archived_once(spark):
    rows, path = _months(spark)
    before, archive = _files(spark, path, rows.schema), scratch_path(spark, "archive")
    for _ in range(2):
        left, archived = archive_partitions(spark, path, rows.schema, "month", ["2026-01", "2025-12"], archive)
        assert left.count() == 20 and archived.count() == 10 and archived.select("month").distinct().count() == 1
        spark.catalog.refreshByPath(path)
    now = _files(spark, path, rows.schema)
    assert now == {m: before[m] for m in ("2026-02", "2026-03")}


# Sketches.

def test_sketches_unite_within_three_percent(spark):
    rows = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") * 7919 % 23_000).alias("who"))
    sketches = sketch_table(rows, ["month"], "who")
    for months in ((0,), (0, 1, 2), tuple(range(12))):
        wanted = F.col("month").isin(*months)
        exact = rows.where(wanted).select("who").distinct().count()
        guess = united(sketches.where(wanted), [], "n").first()["n"]
        assert abs(guess - exact) <= 0.03 * exact
    assert sketches.count() == 12


# Bands.

def _by_hand(values, bands):
    out = []
    for key, v in values:
        found = [label for low, high, label in bands if v is not None and (low is None or v >= low) and (high is None or v < high)]
        out += [(key, label) for label in found] or [(key, None)]
    return sorted(out, key=str)


def test_thousands_of_bands_with_gaps_bounds_and_nulls(spark):
    rng = random.Random(3)
    bands, low = [(None, 0.0, "below")], 0.0
    for i in range(3000):
        high = low + rng.choice([0.5, 1.0, 40.0, 3000.0] if i % 500 == 0 else [0.5, 1.0])
        bands.append((low, high, f"b{i}"))
        low = high + rng.choice([0.0, 0.25])
    bands.append((low + 1, None, "above"))
    values = [(i, rng.choice([b[0] for b in rng.sample(bands[1:], 3)] + [rng.uniform(-10, low + 20), None])) for i in range(3000)]
    frame = spark.createDataFrame(values, "id int, x double")
    found = band_join(frame, "x", spark.createDataFrame(bands, "low double, high double, label string"))
    assert sorted(((r["id"], r["label"]) for r in found.collect()), key=str) == _by_hand(values, bands)
    assert "NestedLoop" not in _plan(found) and "CartesianProduct" not in _plan(found)


@pytest.mark.parametrize("bands", [[], [(None, None, "all")], [(5.0, 5.0, "empty"), (1.0, 2.0, "a"), (1.5, 4.0, "b")], [(None, 3.0, "low")]])
def test_few_open_empty_and_overlapping_bands(spark, bands):
    values = [(1, 1.75), (2, 5.0), (3, None), (4, -7.5)]
    found = band_join(spark.createDataFrame(values, "id int, x double"), "x", spark.createDataFrame(bands, "low double, high double, label string"))
    assert sorted(((r["id"], r["label"]) for r in found.collect()), key=str) == _by_hand(values, bands)


# Bad lines.

SALES = table("id int?, day date?, amount money?, note string?")


def test_bad_lines_are_set_apart_with_their_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day,amount,note\n1,2026-01-02,3.50,fine\nx,2026-01-02,1,word\n2,,,\n\n3,2026-01-05\n4,2026-01-05,1.00,\"a, b\"\n")
    (tmp_path / "b.csv").write_text("id,day,amount,note\n5,2026-13-40,1,no day\n6,2026-01-06,7,ok,more\n7,2026-01-07,9.25,ok\n")
    good, bad = load_tolerant(spark, str(tmp_path), SALES)
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 4, 7] and good.columns == SALES.fieldNames()
    assert {r["id"]: r["note"] for r in good.collect()}[4] == "a, b"
    assert sorted((r["file"].rsplit("/", 1)[1], r["line_no"]) for r in bad.collect()) == [("a.csv", 3), ("a.csv", 6), ("b.csv", 2), ("b.csv", 3)]
    assert good.count() + bad.count() + 2 + 1 == 7 + 4  # two headers, one blank line
    with pytest.raises(TooManyBadLines, match="4 bad lines, 3 allowed"):
        load_tolerant(spark, str(tmp_path), SALES, most_bad=3)


def test_numbers_hold_where_a_file_is_cut_into_splits(spark, tmp_path):
    (tmp_path / "long.csv").write_text("id\n" + "".join(f"{i if i % 1000 else 'bad'}\n" for i in range(1, 60_001)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        staging, rejected = str(tmp_path / "staging"), str(tmp_path / "rejected")
        good, bad = bulk_load_tolerant(spark, str(tmp_path / "long.csv"), StructType.fromDDL("id int"), staging, rejected, most_bad=60)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert good.count() == 59_940 and sorted(r["line_no"] for r in bad.collect()) == [i + 1 for i in range(1000, 60_001, 1000)]
    with pytest.raises(TooManyBadLines):
        bulk_load_tolerant(spark, str(tmp_path / "long.csv"), StructType.fromDDL("id int"), staging, rejected, most_bad=59)
    assert spark.read.parquet(staging).count() == 59_940


# Clustered files.

def test_a_lookup_reads_less_than_a_hundredth_of_the_rows(spark):
    rows = spark.range(400_000).select(F.col("id").alias("order"), (F.col("id") * 7_919 % 399_989).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("filler"))
    path = write_clustered(rows, scratch_path(spark, "clustered"), ["order"], ["code"], files=16, group_bytes=256 << 10, distinct=20_000)
    by_key = clustered_lookup(spark, path, order=123_456)
    assert [r["code"] for r in by_key.collect()] == [123_456 * 7_919 % 399_989]
    assert rows_scanned(by_key) < 4_000
    # The code is in no order; only its filter can skip row groups.
    missing, present = clustered_lookup(spark, path, code=399_999), clustered_lookup(spark, path, code=77)
    assert rows_scanned(missing) < 100_000 and present.count() == rows.where("code = 77").count()
    assert rows_scanned(present) < 400_000
