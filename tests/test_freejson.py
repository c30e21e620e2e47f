"""Records without a declared type against pandas on the same payloads."""

from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from abacarium.operators import freejson
from abacarium.operators.freejson import flatten_free, infer_clean, infer_etl, read_free, record_schema
from abacarium.operators.jsonclean import CleanConfig

RECORDS = [
    {"id": 1, "name": "a", "owner": {"login": "x", "plan": {"tier": 1}}, "description": None, "topics": ["p", "q"], "created_at": "2026-01-02T03:04:05Z"},
    {"id": 2, "owner": {"login": None}, "description": "d", "empty": None, "created_at": "soon", "rating": 4},
    {"id": 2, "owner": {"login": None}, "description": "d", "empty": None, "created_at": "soon", "rating": 4},
    {"id": 3, "name": "c", "owner": {"login": "z", "plan": {"tier": 2.5}}, "topics": [], "rating": "good", "odd name.with dot": True, "updated_at": 5},
    {"id": 4, "name": None, "links": [{"rel": "self", "n": 1}, {"rel": "next"}], "rating": [1, {"a": None}], "a`b": 1},
]


def landed(tmp_path, *payloads):
    for i, payload in enumerate(payloads):
        (tmp_path / f"{i}.json").write_text(payload if isinstance(payload, str) else json.dumps(payload, indent=1))
    return str(tmp_path)


def test_the_fields_are_those_that_pandas_finds(spark, tmp_path):
    path = landed(tmp_path, {"items": RECORDS[:2]}, RECORDS[2:4], RECORDS[4], "  \n ")
    flat = flatten_free(read_free(spark, path))
    expected = pd.json_normalize(RECORDS)
    # pandas calls a list of objects in a column by its name, as it stays whole; a missing object has no column of its own.
    assert sorted(flat.columns) == sorted(expected.columns)
    got = {tuple(r[c] for c in ("id", "name", "`owner.login`".strip("`"))) for r in flat.collect()}
    assert got == {(1, "a", "x"), (2, None, None), (3, "c", "z"), (4, None, None)}
    types = dict(flat.dtypes)
    assert types["topics"] == "array<string>" and types["links"] == "array<struct<n:bigint,rel:string>>" and types["id"] == "bigint"
    assert types["owner.plan.tier"].startswith("decimal") and types["rating"] == "string" and types["empty"] == "string"
    rating = {r["id"]: r["rating"] for r in flat.collect()}
    assert rating == {1: None, 2: "4", 3: "good", 4: '[1,{"a":null}]'}
    assert flat.where(F.col("`odd name.with dot`")).count() == 1 and flat.where(F.col("`a``b`") == 1).count() == 1


def test_clean_as_a_declared_table(spark, tmp_path):
    rows = infer_clean(read_free(spark, landed(tmp_path, RECORDS)))
    assert rows.columns == ["id", "name", "owner", "description", "created_at", "updated_at"]
    found = {r["id"]: r for r in rows.collect()}
    assert rows.count() == 4 and found[1]["description"] == "No description" and found[2]["description"] == "d"
    assert str(found[1]["created_at"]) == "2026-01-02 03:04:05" and found[2]["created_at"] is None and found[3]["updated_at"] is None


def test_columns_without_a_value_vanish_and_none_listed_keeps_all(spark, tmp_path):
    path = landed(tmp_path, RECORDS)
    rows = infer_clean(read_free(spark, path), CleanConfig(columns=("id", "empty")))
    assert rows.columns == ["id"] and rows.count() == 4
    every = infer_clean(read_free(spark, path), CleanConfig(columns=("nothing",), dates=(), fills={}, renames={}))
    assert "empty" not in every.columns and "owner.plan.tier" in every.columns


def test_no_records_and_payloads_that_are_no_records(spark, tmp_path):
    empty = read_free(spark, landed(tmp_path, [], {"items": []}))
    assert empty.count() == 0 and infer_clean(empty).columns == [] and infer_clean(empty).count() == 0
    other = tmp_path / "other"
    other.mkdir()
    with pytest.raises(ValueError, match="have to be objects"):
        record_schema(read_free(spark, landed(other, [1, 2])))
    assert read_free(spark, landed(other, {"items": 3, "a": 1})).count() == 1


def test_keys_that_are_data_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(freejson, "MOST_COLUMNS", 20)
    records = read_free(spark, landed(tmp_path, [{"id": i, f"user{i}": 1} for i in range(30)]))
    with pytest.raises(ValueError, match="31 columns"):
        flatten_free(records)
    assert flatten_free(records, columns=["id", "user7"]).columns == ["id", "user7"]


def test_etl_writes_lists_as_json(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out" / "deep")
    source.mkdir()
    config = CleanConfig(columns=("id", "topics"), dates=(), fills={}, renames={})
    infer_etl(spark, landed(source, {"items": RECORDS}), target, config)
    back = {r["id"]: r["topics"] for r in spark.read.option("header", True).csv(target).collect()}
    assert back == {"1": '["p","q"]', "2": None, "3": "[]", "4": None}


def test_one_aggregate_and_no_rows_on_the_driver(spark, tmp_path):
    """Fields that only one record in thousands has are found; lines are split among tasks."""
    path = str(tmp_path / "lines")
    spark.range(20_000).select(F.when(F.col("id") == 19_999, F.lit('{"id": 1, "rare": {"x": "y"}}')).otherwise(
        F.format_string('{"id": %d}', "id")).alias("value")).write.text(path)
    flat = flatten_free(read_free(spark, path, multi_line=False))
    assert flat.columns == ["id", "rare.x"] and flat.where(F.col("`rare.x`") == "y").count() == 1
