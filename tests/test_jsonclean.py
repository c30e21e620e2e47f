"""Nested JSON payloads to clean rows and CSV files."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from abacarium.operators.jsonclean import REPOSITORY_COLUMNS, CleanConfig, clean, flatten, json_etl, read_records
from declared import REPOSITORY
from abacarium.session import scratch_path


def _record(i, description="text", created="2011-02-13T18:38:17Z", **more):
    return {"id": i, "name": f"repo{i}", "full_name": f"org{i}/repo{i}", "owner": {"login": f"org{i}"},
            "html_url": f"https://example.com/{i}", "description": description, "language": "Python",
            "stargazers_count": 100 * i, "forks_count": i, "open_issues_count": 0, "created_at": created,
            "updated_at": "2024-01-01T00:00:00Z", **more}


@pytest.fixture
def land(spark, tmp_path):
    def _land(payload):
        folder = tmp_path / "landed"
        folder.mkdir(exist_ok=True)
        (folder / f"{len(list(folder.iterdir()))}.json").write_text(json.dumps(payload))
        return str(folder)

    return _land


@pytest.mark.parametrize("wrap, rows", [
    (lambda items: {"total_count": 2, "items": items}, 2), (lambda items: items, 2), (lambda items: items[0], 1),
    (lambda items: {"items": []}, 0), (lambda items: [], 0),
])
def test_envelopes(spark, land, wrap, rows):
    records = read_records(spark, land(wrap([_record(1), _record(2)])), REPOSITORY)
    assert records.count() == rows and records.columns == REPOSITORY.fieldNames()


def test_many_files_and_bad_json(spark, land, tmp_path):
    land({"items": [_record(1)]})
    folder = land([_record(2)])
    assert read_records(spark, folder, REPOSITORY).count() == 2
    (Path(folder) / "bad.json").write_text("{not json")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_records(spark, folder, REPOSITORY).collect()


def test_clean(spark, land):
    path = land([_record(1), _record(1), _record(2, description=None, created="never")])
    rows = {r["id"]: r for r in clean(read_records(spark, path, REPOSITORY)).collect()}
    assert set(rows) == {1, 2}
    assert list(rows[1].asDict()) == ["owner" if c == "owner.login" else c for c in REPOSITORY_COLUMNS]
    assert rows[1]["owner"] == "org1" and rows[1]["created_at"].year == 2011
    assert rows[2]["description"] == "No description" and rows[2]["created_at"] is None


def test_empty_columns_vanish_before_the_fill(spark, land):
    path = land([_record(1, description=None), _record(2, description=None)])
    records = read_records(spark, path, REPOSITORY)
    assert "description" in clean(records).columns
    assert "description" not in clean(records, CleanConfig(drop_empty_columns=True)).columns


def test_without_listed_columns_all_are_kept(spark):
    df = spark.sql("SELECT named_struct('y', 1, 'z', named_struct('w', 2)) AS x, array(1, 2) AS many")
    assert flatten(df).columns == ["x.y", "x.z.w", "many"]
    assert clean(df).columns == ["x.y", "x.z.w", "many"]


def test_etl_writes_csv_with_header(spark, land):
    target = scratch_path(spark, "out") + "/deep/folder"
    rows = json_etl(spark, land({"items": [_record(1), _record(2)]}), target, REPOSITORY)
    back = spark.read.option("header", True).csv(target)
    assert back.columns == rows.columns and back.count() == 2
