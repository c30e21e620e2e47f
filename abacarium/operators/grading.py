"""Grade banding and report cards over a table of marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.functions import GRADE_BANDS, grade_band, ratio, trimmed_or
from abacarium.operators.quality import Check

MARK_RULE = Check("marks in 0..100", "marks", "marks BETWEEN 0 AND 100")


def graded(marks: DataFrame, bands=tuple(GRADE_BANDS)) -> DataFrame:
    """Each mark with its grade."""
    return marks.withColumn("grade", grade_band("marks", bands))


def report_card(marks: DataFrame, bands=tuple(GRADE_BANDS), max_marks: int = 100) -> DataFrame:
    """Total, possible, average and overall grade per student."""
    total, count = F.sum(F.col("marks").cast("decimal(9,2)")), F.count(F.lit(1))
    card = marks.groupBy("student").agg(
        total.cast("double").alias("total_marks"),
        (count * max_marks).alias("total_possible"),
        ratio(total, count).alias("average"),
    )
    return card.withColumn("overall_grade", grade_band("average", bands))


def named(marks: DataFrame) -> DataFrame:
    """Blank names replaced by a default, as at data entry."""
    return marks.withColumns({
        "student": trimmed_or("student", "Student"), "subject": trimmed_or("subject", "Subject"),
    })
