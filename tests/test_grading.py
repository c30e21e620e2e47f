from __future__ import annotations

from pyspark.sql import functions as F

from abacarium.functions import band, grade_band, mean, percentage, round_half_even, trimmed_or
from abacarium.operators.grading import MARK_RULE, named, report_card
from abacarium.operators.quality import row_violations


def test_band_limits(spark):
    marks = [100, 90, 89.99, 80, 70, 60, 50, 40, 39.99, 0, None]
    df = spark.createDataFrame([(float(m) if m is not None else None,) for m in marks], "m double")
    assert [r[0] for r in df.select(grade_band("m")).collect()] == [
        "A+", "A+", "A", "A", "B", "C", "D", "E", "F", "F", None]
    assert [r[0] for r in df.select(band("m", [(50, "pass")], "fail")).collect()][6:8] == ["pass", "fail"]


def test_report_card(spark):
    df = spark.createDataFrame([("x", "a", 90.0), ("x", "b", 79.5), ("y", "a", 39.0), (" ", "", 101.0)],
                               "student string, subject string, marks double")
    rows = {r["student"]: r for r in report_card(named(df)).collect()}
    assert (rows["x"]["total_marks"], rows["x"]["total_possible"], rows["x"]["average"], rows["x"]["overall_grade"]) == (
        169.5, 200, 84.75, "A")
    assert rows["y"]["overall_grade"] == "F" and "Student" in rows
    assert [r["detail"] for r in row_violations(df, [MARK_RULE], ["student"]).collect()] == ["not (marks BETWEEN 0 AND 100)"]


def test_rounding(spark):
    row = spark.range(1).select(
        mean(F.lit(1), F.lit(8)).alias("up"), mean(F.lit(-1), F.lit(8)).alias("down"),
        percentage(F.lit(1), F.lit(3)).alias("third"), percentage(F.lit(1), F.lit(0)).alias("none"),
        round_half_even(F.lit("2.125").cast("decimal(6,3)")).alias("even"),
        trimmed_or(F.lit("  "), "x").alias("blank")).first()
    assert [str(v) for v in row] == ["0.13", "-0.13", "33.33", "None", "2.12", "x"]
