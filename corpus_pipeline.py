"""From documents to token ids: language, exact copies, near copies, benchmark passages, encoding.

Every stage but the last returns rows of ``documents`` with all their columns. A
stage drops rows by its operator's verdict on the row, not on the id: the language
is told row by row, exact copies go by id and text, the other two by a row number
that is written with the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from abacarium.llm.bpe import build_encoder, round_trip
from abacarium.llm.common import read_table, remainder, stored, vocabulary_path
from abacarium.llm.exact_dedup import exact_groups, text_digest
from abacarium.llm.jaccard import similar_groups
from abacarium.llm.language import fit, recognised
from abacarium.llm.winnow import decontaminate

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, fixed by writing it, and the name of that column."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or below a score of 0.3 go."""
    return recognised(docs, fit(docs.where(remainder("doc_id", 4) != 2)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest original of each group of equal texts, of equally long ones that of the smallest id; one row of each group stays."""
    kept = stored(exact_groups(docs).where("kept").select(F.col("doc_id").alias("_id"), "text_sha256"), "kept")
    digest = "_digest"
    while digest in docs.columns:
        digest += "_"
    marked = docs.withColumn(digest, text_digest(F.col("text")))
    chosen = kept.distinct()
    out = marked.join(chosen, marked["doc_id"].eqNullSafe(chosen["_id"]) & (marked[digest] == chosen["text_sha256"]), "left_semi")
    if not kept.groupBy("_id", "text_sha256").count().where("count > 1").isEmpty():
        # An id that repeats: of its rows the longest, then the first.
        rows, row = _numbered(out)
        rank = F.struct((-F.length(F.coalesce(F.col("text"), F.lit("")))).alias("size"), F.col(row).alias("at"))
        first = rows.groupBy("doc_id", digest).agg(F.min(rank).alias("stays")).select(F.col("stays.at").alias(row))
        out = rows.join(first, row, "left_semi").drop(row)
    return out.drop(digest)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest id, NULL last, then the first row.

    Similar is what ``op2_jaccard_join`` calls so, shingles of three words and 90 of 100, so
    that the stage drops by the groups that the query reports and its SQL checks. The usual
    rule of five words and 0.8 is wider for evenly spread edits in about 2 % of the words.
    """
    rows, row = _numbered(docs)
    groups = similar_groups(rows, row, shingle=3, percent=90).select(F.col(row).alias("at"), F.col("component_id").alias("group"))
    ids = rows.select(F.col(row).alias("at"), F.col("doc_id").cast("long").alias("id"))
    first = groups.join(ids, "at").groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "at")).alias("stays"))
    return rows.join(first.select(F.col("stays.at").alias(row)), row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than 5 % lie in benchmark passages."""
    rows, row = _numbered(docs)
    found = decontaminate(rows, read_table(spark, sf_dir, "benchmark"), row)
    return rows.join(found.where("contaminated").select(row), row, "left_anti").drop(row)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, their number, and the digests of ids and decoded text."""
    return round_trip(docs, build_encoder(docs, vocabulary_path()), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
    ("decontamination", decontamination), ("encoding", encoding),
]

#: Not expressible in SQL: the stages train a model and split words.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
