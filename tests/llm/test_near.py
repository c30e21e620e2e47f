"""b-bit MinHash against all pairs, and the Jaccard join on texts that share a template."""

from __future__ import annotations

import importlib
import random
import time

import numpy as np
import pytest
from llm import brute
from llm.test_copies import counted
from pyspark.sql import functions as F

from abacarium.llm import bbit_minhash
from abacarium.llm.bbit_minhash import MARGIN, bands, estimate, minima, near_copies, packed
from abacarium.llm.jaccard import similar_groups


def expected(rows, percent):
    return brute.Counter({(d, n, low, d == low): c for (d, n, low), c in brute.similar(rows, percent).items()})


def template_rows(n, own=8, words=100, seed=3):
    """Texts of ``words`` words, all but ``own`` of them common."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(words - own)]
    return [(i, " ".join(common + [f"o{rng.randrange(10**9)}" for _ in range(own)])) for i in range(n)]


def test_near_copies_match_all_pairs(spark):
    rows = brute.near_copies(seed=5) + [(1000 + i, t) for i, (_, t) in enumerate(brute.odd_rows())]
    found = near_copies(brute.docs_frame(spark, rows), shingle=3, percent=85)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert counted(found) == expected(rows, 85)


def test_near_copies_with_null_and_repeated_keys(spark):
    rows = [*brute.odd_rows(), (None, None), (None, "only NULL keys here"), (None, "only null keys here")]
    assert counted(near_copies(brute.docs_frame(spark, rows), shingle=3, percent=85)) == expected(rows, 85)


def test_buckets_that_stay_open_are_joined_exactly(spark):
    """Hundreds of texts around a template, just not similar, with a near copy each."""
    rows = template_rows(150, own=6, words=60)
    rows += [(1000 + i, t + " end") for i, t in rows]
    found = near_copies(brute.docs_frame(spark, rows), shingle=3, percent=85)
    assert counted(found) == expected(rows, 85)
    assert found.where("not kept").count() >= 150


def test_the_join_of_open_buckets_goes_on_from_known_groups(spark, monkeypatch):
    """Groups known from the buckets are not found again, and writing of edges ends as soon as all are stars."""
    from abacarium.llm import components

    written = []
    monkeypatch.setattr(components, "stored_at", lambda df, label, write=components.stored_at: written.append(label) or write(df, label))
    rows = template_rows(60, own=6, words=60)
    rows += [(1000 + i, t + " end") for i, t in rows]
    found = near_copies(brute.docs_frame(spark, rows), shingle=3, percent=85)
    assert counted(found) == expected(rows, 85)
    assert 3 <= len(written) <= 5, written


def test_a_large_group_and_repeated_texts(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(200):
        own = list(base)
        own[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(own if i % 3 else base)))
    assert counted(near_copies(brute.docs_frame(spark, rows), shingle=3, percent=85)) == expected(rows, 85)


def test_empty_table_and_long_texts(spark):
    assert near_copies(brute.docs_frame(spark, []).limit(0)).count() == 0
    long = " ".join(f"w{i % 7919}x{i % 1009}" for i in range(150_000))
    found = {r["doc_id"]: r["component_id"] for r in near_copies(brute.docs_frame(spark, [(5, long), (3, long + " a"), (4, "a")])).collect()}
    assert found == {5: 3, 3: 3, 4: 4}


def test_the_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    rows, truth = [], []
    for share in (0.0, 0.3, 0.7, 0.9):
        for _ in range(40):
            x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            y = np.concatenate([x[: int(1000 * share)], rng.integers(0, 1 << 63, 1000 - int(1000 * share), dtype=np.uint64)])
            truth.append(len(np.intersect1d(x, y)) / len(np.union1d(x, y)))
            rows.append((packed(minima(x)).tolist(), packed(minima(y)).tolist()))
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x array<bigint>, y array<bigint>")
    got = [r["e"] for r in frame.withColumn("e", estimate(F.col("x"), F.col("y"))).orderBy("i").collect()]
    off = np.array(got) - np.array(truth)
    assert np.abs(off).max() < MARGIN
    assert np.abs(off.reshape(4, 40).mean(axis=1)).max() < 0.03


def test_bands_meet_at_the_wanted_similarity():
    rng = np.random.default_rng(7)
    met = 0
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        y = np.concatenate([x[:184], rng.integers(0, 1 << 63, 16, dtype=np.uint64)])  # 184 of 216: 0.852
        met += bool((bands(minima(x)) == bands(minima(y))).any())
    assert met == 300
    assert (1 - 0.85**bbit_minhash.ROWS) ** bbit_minhash.BANDS < 1e-6


@pytest.mark.parametrize("percent", [90, 80])
def test_the_join_on_templates_matches_all_pairs(spark, percent):
    rows = template_rows(120, own=10) + [(1000 + i, t + " z") for i, t in template_rows(30, own=10)]
    assert counted(similar_groups(brute.docs_frame(spark, rows), percent=percent)) == brute.similar(rows, percent)


def test_the_join_on_templates_stays_linear(spark):
    took = []
    for n in (3000, 12000):
        docs = spark.createDataFrame(template_rows(n), "doc_id bigint, text string").repartition(4)
        began = time.time()
        assert similar_groups(docs).where("doc_id <> component_id").count() == 0
        took.append(time.time() - began)
    assert took[1] < 2.5 * took[0] + 5


@pytest.mark.parametrize("module", ["bbit_minhash", "jaccard"])
def test_whole_sets_are_told_apart_once(spark, monkeypatch, module):
    """Equal sets go before they are written, into few files, and not again on either side of every join."""
    module, plans = importlib.import_module(f"abacarium.llm.{module}"), []

    def watched(pairs, sets, percent, find=module.confirmed):
        plans.append(sets._jdf.queryExecution().analyzed().toString())
        return find(pairs, sets, percent)

    monkeypatch.setattr(module, "confirmed", watched)
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " more"), (4, "quite another text")], "doc_id bigint, text string")
    find = module.near_copies if module is bbit_minhash else module.similar_groups
    assert {r["doc_id"]: r["component_id"] for r in find(docs, shingle=3, percent=85).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    assert plans and not any("Deduplicate" in p or "Aggregate" in p for p in plans), plans


def test_no_plan_holds_all_steps_of_the_set_join(spark, monkeypatch):
    from abacarium.llm import jaccard

    joins = []

    def watched(edges, a="a", b="b", find=jaccard.components):
        joins.append(edges._jdf.queryExecution().analyzed().toString().count("Join "))
        return find(edges, a, b)

    monkeypatch.setattr(jaccard, "components", watched)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words) + " more"), (3, "quite another text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert len(joins) == 2 and max(joins) <= 4, joins
