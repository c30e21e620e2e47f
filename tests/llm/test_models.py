"""Language and toxicity models by held-out accuracy, the pipeline stage by stage, the registered queries."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from compare import connect, differences
from llm import brute
from pyspark.sql import functions as F

import corpus_pipeline
from abacarium.llm import language, toxicity
from abacarium.llm.common import read_table, remainder
from abacarium.llm.ftrl import Penalty, softmax, temperature, train, weights
from abacarium.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


def test_language_of_held_out_documents(spark):
    docs = read_table(spark, SF, "documents")
    found = QUERIES["op1_language"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    joined = found.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").agg(
        F.avg(F.expr("IF(lang = lang_pred, 1.0, 0.0)")), F.count("*"), F.min("score"), F.max("score")).first()
    assert joined[1] > 30 and joined[0] > 0.9 and joined[2] >= 0 and joined[3] <= 1
    assert found.where(F.col("held_out") != (remainder("doc_id", 4) == 2)).count() == 0


def test_language_of_odd_texts(spark):
    rows = spark.createDataFrame([(i, t, lang) for i in range(20) for t, lang in ((f"the cat {i} and the hat", "en"), (f"der hund {i} und die maus", "de"))] + [
        (90, None, "en"), (91, "text", None)], "doc_id bigint, text string, lang string")
    model = language.fit(rows)
    assert model.classes == ["de", "en"]
    got = {r["doc_id"]: r for r in language.predict(brute.docs_frame(spark, [*brute.odd_rows(), (30, "12 34 !?"), (31, "und der hund")]), model).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (1, 2, 3, 12, 30))
    assert got[31]["lang_pred"] == "de" and got[7]["lang_pred"] in ("de", "en")
    nothing = language.fit(rows.limit(0))
    assert language.predict(rows, nothing).where("lang_pred <> 'und'").count() == 0
    assert language.predict(rows.limit(0), model).count() == 0


def test_long_texts_score_as_the_sum_of_their_pieces():
    text = "".join(random.Random(1).choice("abcdé ") for _ in range(3 * language.PIECE // 2))
    whole = np.concatenate(list(language.features(text)))
    saved, language.PIECE = language.PIECE, 10 * len(text)
    try:
        assert sorted(np.concatenate(list(language.features(text)))) == sorted(whole)
    finally:
        language.PIECE = saved


def test_ftrl_learns_and_prunes(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        label = i % 2
        rows.append((i, [label, 2 + int(rng.integers(50))], [1.0, 0.05], [float(label == 0), float(label == 1)]))
    frame = spark.createDataFrame(rows, "order bigint, idx array<int>, val array<float>, target array<double>")
    w = train(frame, 52, 2, Penalty(l1=0.3))
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 > w[1, 0]
    assert (w[2:] == 0).mean() > 0.5
    assert (train(frame.limit(0), 52, 2) == 0).all()
    assert weights(np.array([0.1]), np.array([1.0]), Penalty(l1=0.2))[0] == 0


def test_temperature_softens_overconfident_logits(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(2000):
        true = rng.normal(size=3)
        rows.append(([float(v) * 4 for v in true], int(rng.choice(3, p=softmax(true)))))
    assert 2.5 < temperature(spark.createDataFrame(rows, "logits array<double>, label int")) < 6
    assert temperature(spark.createDataFrame([], "logits array<double>, label int")) == 1.0


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(2)
    truth = rng.random(3000) < 0.2
    strong = np.where(truth, rng.random(3000) < 0.9, rng.random(3000) < 0.02)
    weak = np.where(truth, rng.random(3000) < 0.5, rng.random(3000) < 0.3)
    fired = np.stack([strong, strong, strong, weak, np.where(truth, rng.random(3000) < 0.8, rng.random(3000) < 0.05)], 1).astype(float)
    start = np.where(rng.random(3000) < 0.1, ~truth, truth)
    model = toxicity.LabelModel(fired, start, 0.2)
    assert model.hit[0] > model.hit[3] and model.miss[0] < model.miss[3]
    assert model.correlation[0, 1] > 0.9 and model.weight[0] < 0.5 < model.weight[4]
    assert ((model.posterior(fired) > 0.5) == truth).mean() > 0.9


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = read_table(spark, folder, "labels")
    found = QUERIES["op10_toxicity"](spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    bad, good = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    above = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert above > 0.8 and np.mean([g < 0.5 for g in good]) > 0.97


def test_terms_are_counted_beyond_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FLUSH", 50)
    rows = [(i, f"plain words here {i % 7}" + (" zorgon" if i < 600 and i % 50 == 0 else ""), int(i < 600)) for i in range(2600)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3)
    model = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"), per_class=30)
    assert "zorgon" in model.voters and "plain" not in model.voters


def _busy(spark, other):
    """Half of the rows have one id, a third of all are one text."""
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        text = " ".join(rng.choice(("plain", "words", "of", "text", f"w{i}")) for _ in range(8))
        rows.append((7 if i % 2 else i, "the same text again" if i % 3 == 0 else text, "en" if i % 5 else "de", int(i % 4 == 0)))
    return spark.createDataFrame([(other if d == 7 else d, *r) for d, *r in rows], "doc_id bigint, text string, lang string, toxic int").repartition(5)


@pytest.mark.parametrize("busy", [7, 12, 99_999])
def test_bounds_of_the_fits_hold_for_repeated_ids_and_texts(spark, monkeypatch, busy):
    table = _busy(spark, busy)
    seen = []
    for module, features in ((language, 1 << language.BITS), (toxicity, None)):
        def spy(rows, *more, **kw):
            seen.append(rows.count())
            return train(rows, *more, **kw)

        monkeypatch.setattr(module, "train", spy)
    language.fit(table, per_language=50)
    labels = table.select("doc_id", F.lit(1).alias("toxic") if busy == 12 else F.pmod("doc_id", F.lit(2)).alias("toxic")).distinct()
    toxicity.fit(table.select("doc_id", "text"), labels, per_class=50)
    assert len(seen) == 2 and all(10 < n < 2 * 2 * 50 for n in seen)


def test_toxicity_of_odd_tables(spark):
    docs = brute.docs_frame(spark, [*brute.odd_rows(), (60, "you are an idiot, you moron")])
    labels = spark.createDataFrame([(60, 1, 1), (9, 1, 0), (10, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for model in (toxicity.fit(docs, labels), toxicity.fit(docs, labels.limit(0)), toxicity.fit(docs.limit(0), labels)):
        got = toxicity.score(docs, model)
        assert got.count() == len(brute.odd_rows()) + 1 and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), CHECKS[name]) is None


@pytest.mark.parametrize("number", range(1, 14))
def test_every_operator_is_registered(number):
    assert sum(name.startswith(f"op{number}_") for name in QUERIES) == 1


def test_pipeline_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact_dedup", "near_dedup", "decontamination", "encoding"]
    docs = read_table(spark, SF, "documents")
    step = docs.unionByName(spark.createDataFrame(
        [(10**6, "", "en", "x", 0), (10**6 + 1, None, "en", "x", 0), (10**6 + 2, "12 34", "en", "x", 5)], docs.schema))
    seen = {}
    for name, stage in stages.items():
        step = stage(spark, step, SF).cache()
        seen[name] = step.count()
        if name != "encoding":
            assert step.columns == docs.columns
    assert step.columns[:2] == ["doc_id", "n_tokens"]
    assert docs.count() * 0.97 < seen["language"] <= docs.count()
    assert seen["exact_dedup"] < seen["language"]
    assert seen["decontamination"] <= seen["near_dedup"] <= seen["exact_dedup"]


def test_repeated_rows_survive_the_exact_stage_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab"), (3, "c"), (None, "d"), (None, "d"), (4, None), (5, "")], "doc_id bigint, text string")
    out = corpus_pipeline.exact_dedup(spark, docs, SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == [(0, "d"), (1, "a b"), (3, "c"), (4, "")]


def test_the_longest_original_of_a_repeated_id_stays(spark):
    rows = [(1, "a b"), (1, "a    b"), (2, "ab"), (None, "c"), (None, " c"), (3, None), (3, "   ")]
    for order in (rows, rows[::-1]):
        out = corpus_pipeline.exact_dedup(spark, spark.createDataFrame(order, "doc_id bigint, text string").coalesce(1), SF)
        assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, " c"), (1, "a    b"), (3, "   ")]


def test_stages_with_null_and_empty_texts_and_empty_tables(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, " \n ", "k"), (3, " \n ", "k"), (None, None, None), (4, "some words of a text", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string")
    near = corpus_pipeline.near_dedup(spark, docs, SF)
    assert near.columns == docs.columns and near.count() == len(rows), "texts without words are alike with nothing"
    assert corpus_pipeline.decontamination(spark, docs, SF).count() == len(rows)
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.encoding(spark, docs, SF).collect()}[2] == 0
    for name, stage in corpus_pipeline.STAGES[1:]:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0 and (name == "encoding" or empty.columns == docs.columns)


def test_the_pipeline_on_empty_documents(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        table = read_table(spark, SF, name)
        (table.limit(0) if name == "documents" else table).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_judge_rows_with_null_or_equal_ids_one_by_one(spark):
    near = " ".join(f"v{i}" for i in range(400))
    item = read_table(spark, SF, "benchmark").first()["text"]
    clean = "nothing of that kind stands in this text"
    rows = [(None, near), (None, near + " end"), (7, near + " last"), (7, clean), (None, clean + " either"), (7, item), (None, item + " more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs.where("text LIKE 'v%' OR text LIKE 'nothing%'"), SF)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, clean + " either"), (7, clean), (7, near + " last")]
    left = corpus_pipeline.decontamination(spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == sorted((d or 0, t) for d, t in rows[:5])


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "abacarium").rglob("*.py"):
        if "llm" not in path.parts:
            assert "abacarium.llm" not in path.read_text(), path
