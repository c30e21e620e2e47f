"""Exact copies, near copies, line copies and components against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from llm import brute
from pyspark.sql import functions as F

from abacarium.llm.components import components
from abacarium.llm.exact_dedup import exact_groups
from abacarium.llm.jaccard import choose, similar_groups
from abacarium.llm.line_dedup import WIDTH, repeated_lines, without_lines
from abacarium.session import stored_at


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_groups_match_a_plain_version(spark):
    rows = brute.odd_rows() + [(20 + i, "same text" + " " * (i % 3)) for i in range(40)]
    found = exact_groups(brute.docs_frame(spark, rows))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert counted(found) == brute.exact(rows)


def test_texts_with_equal_digests_stay_apart(spark):
    rows = [(1, "ab"), (2, "a b"), (3, "cd"), (4, "xyz"), (5, "x y z"), (6, None)]
    weak = exact_groups(brute.docs_frame(spark, rows), digest=lambda text: F.length(text).cast("string"))
    assert counted(weak) == brute.exact(rows)


def test_similar_groups_match_all_pairs(spark):
    rows = brute.near_copies() + [(1000 + i, t) for i, (_, t) in enumerate(brute.odd_rows())]
    found = similar_groups(brute.docs_frame(spark, rows))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert counted(found) == brute.similar(rows)


def test_similar_groups_with_null_and_repeated_keys(spark):
    rows = brute.odd_rows()
    assert counted(similar_groups(brute.docs_frame(spark, rows))) == brute.similar(rows)


def test_longer_prefixes_are_asked_for_where_postings_are_many():
    assert choose(np_array([0] * 16), 100, 90) == 1
    assert choose(np_array([0] * 10 + [500, 1, 1, 1, 1, 1]), 100, 90) == 2
    assert choose(np_array([0] * 9 + [500] * 7), 100, 90) == 1


def np_array(values):
    import numpy as np

    return np.array(values)


@pytest.mark.parametrize("function", [exact_groups, similar_groups, repeated_lines])
def test_empty_tables_give_no_rows(spark, function):
    assert function(brute.docs_frame(spark, []).limit(0)).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3), (600, 601), (601, 600)]
    links = brute.Union()
    for a, b in edges:
        if a is not None and a != b:
            links.join(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {n: links.root(n) for n in links.up}


@pytest.mark.parametrize("edges, rounds", [([(1, i) for i in range(2, 9)] + [(20, 21), (21, 20)], 0), ([], 0), ([(1, 2), (2, 3)], 1)])
def test_components_that_are_stars_take_no_further_round(spark, monkeypatch, edges, rounds):
    written = []
    monkeypatch.setattr("abacarium.llm.components.stored_at", lambda df, label: written.append(label) or stored_at(df, label))
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {n: 20 if n in (20, 21) else 1 for e in edges for n in e}
    assert len(written) == 1 + rounds


def lines_by_hand(rows):
    """(key, lines, dropped) by comparing all pairs of distinct lines."""
    seen, places = {}, []
    for at, (d, t) in enumerate(rows):
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                places.append((line.strip(" "), (d is None, d or 0, at), i))
                seen.setdefault(line.strip(" "), len(seen))
    sets = [frozenset(s[i:i + WIDTH] for i in range(max(1, len(s) - WIDTH + 1))) for s in seen]
    links = brute.Union()
    for i, a in enumerate(sets):
        links.root(i)
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                links.join(i, j)
    stays = {}
    for line, row, i in places:
        root = links.root(seen[line])
        stays[root] = min(stays.get(root, (row, i)), (row, i))
    gone = {}
    for line, row, i in places:
        if stays[links.root(seen[line])] != (row, i):
            gone.setdefault(row[2], []).append(i)
    return Counter((d, (t or "").count("\n") + 1, tuple(gone.get(at, ()))) for at, (d, t) in enumerate(rows))


def line_rows():
    rng = random.Random(9)
    alphabet = "abcdefghijklmnopqrstuvwxyz "
    lines = ["".join(rng.choice(alphabet) for _ in range(200)).strip() for _ in range(30)]
    rows = []
    for key in range(60):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(lines))
            if rng.random() < 0.4:
                line[rng.randrange(len(line))] = "#"
            own.append("".join(line))
        rows.append((key, "\n".join(own)))
    return [*rows, (100, None), (101, ""), (102, "\n\n"), (103, "short\nshort\n日本語の行 ひとつ"), (104, "  日本語の行 ひとつ ")]


def test_repeated_lines_match_all_pairs(spark):
    rows = line_rows()
    found = repeated_lines(brute.docs_frame(spark, rows))
    assert found.columns == ["doc_id", "n_lines", "n_kept", "dropped"]
    got = Counter((r[0], r[1], tuple(r[3])) for r in found.collect())
    expected = lines_by_hand(rows)
    lost = sum((expected - got).values())
    assert lost <= 1, "signatures may miss a link in a hundred"
    assert all(r[2] == r[1] - len(r[3]) for r in found.collect())


def test_near_lines_are_found_among_hundreds_that_share_a_passage(spark):
    rng = random.Random(8)

    def some(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(n))

    passage = some(25)
    lines = [f"{passage} {some(8)}" for _ in range(200)]
    rows = [(2 * i + copy, line + "s" * copy) for i, line in enumerate(lines) for copy in (0, 1)]
    got = {r["doc_id"]: r["dropped"] for r in repeated_lines(brute.docs_frame(spark, rows)).collect()}
    assert got == {key: [0] * (key % 2) for key, _ in rows}


def test_one_edit_in_lines_of_usual_length(spark):
    rng = random.Random(10)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)).strip() or "a" for size in range(52, 101) for _ in range(3)]
    rows = [(2 * i, line) for i, line in enumerate(lines)]
    rows += [(2 * i + 1, f"{line[: len(line) // 2]}#{line[len(line) // 2 + 1 :]}") for i, line in enumerate(lines)]
    ends = ["nine char", "fourteen chars", "some twenty odd chars", "a line of about thirty chars in"]
    rows += [(1000 + 2 * i + copy, line + "." * copy) for i, line in enumerate(ends) for copy in (0, 1)]
    got = {r["doc_id"]: r["dropped"] for r in repeated_lines(brute.docs_frame(spark, rows)).collect()}
    wrong = [key for key, _ in rows if got[key] != [0] * (key % 2)]
    assert len(wrong) <= 0.02 * len(lines) and not [key for key in wrong if key >= 1000 or key % 2 == 0]


def test_lines_are_taken_out_of_texts(spark):
    docs = brute.docs_frame(spark, [(1, "a line that repeats\nb"), (2, "c\na line that repeats"), (3, None)])
    out = without_lines(docs, repeated_lines(docs))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a line that repeats\nb", 2: "c", 3: None}
    assert out.columns == docs.columns


def test_marks_keep_similar_lines_and_little_else(spark):
    """Lines of shared pieces meet often; only those that may be similar go on to be verified, and the table of the order is small."""
    from abacarium.llm import line_dedup

    rng = random.Random(8)
    pieces = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(25)) for _ in range(24)]
    lines = [" ".join(rng.sample(pieces, 8)) for _ in range(100)]
    lines += [x[:90] + "#" + x[91:] for x in lines[:20]] + [pieces[0], "q", "qrst"]
    frame = spark.createDataFrame([(b"%04d" % i, b"%04d" % i, x) for i, x in enumerate(lines)], "name binary, root binary, line string")
    found = {(int(r["name"]), int(r["with"])) for r in line_dedup._prefix_pairs(frame).collect()}
    sets = [frozenset(x[i:i + WIDTH] for i in range(max(1, len(x) - WIDTH + 1))) for x in lines]
    alike = {(i, j) for j in range(len(lines)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert len(alike) >= 20 and alike <= found
    assert len(found) <= 2 * len(alike), (len(found), len(alike))
    assert len(line_dedup._order(frame.select(line_dedup.shingles(F.col("line")).alias("set")))) <= 1 << 19


def lines_of_pieces(seed):
    """Lines that share pieces, some with an edit, and short ones; and the pairs that are alike."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(25)).strip() for _ in range(24)]
    lines = [" ".join(rng.sample(pieces, 8)) for _ in range(100)]
    lines += [x[:90] + "#" + x[91:] for x in lines[:20]] + [pieces[0], "q", "qrst", "abcdefghijklmnopq", "abcdefghijklmnopqr", "日本語の行 ひとつ", "日本語の行 ひとつ日"]
    sets = [frozenset(x[i:i + WIDTH] for i in range(max(1, len(x) - WIDTH + 1))) for x in lines]
    return lines, {(i, j) for j in range(len(lines)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


def test_lines_that_share_pieces_are_seldom_verified(spark, monkeypatch):
    """Lines that meet in bands are told apart by marks; before, each of their pairs was taken apart into shingles."""
    from abacarium.llm import line_dedup

    rng = random.Random(14)

    def some(size):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)).strip()

    lines = []
    for _ in range(8):
        passage = some(120)
        lines += [f"{passage} {some(240)}" for _ in range(6)]
        lines.append(lines[-1] + "#")
    verified, similar = [], line_dedup._similar
    monkeypatch.setattr(line_dedup, "_similar", lambda pairs, found: verified.append(pairs.count()) or similar(pairs, found))
    rows = list(enumerate(lines))
    found = Counter((r[0], r[1], tuple(r[3])) for r in repeated_lines(brute.docs_frame(spark, rows)).collect())
    assert found == lines_by_hand(rows)
    assert 8 <= sum(verified) <= 16, verified


def test_marks_of_lines_and_of_sets_lose_no_similar_pair(spark):
    from abacarium.llm import line_dedup

    lines, alike = lines_of_pieces(9)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "name bigint, line string")
    pairs = frame.select("name").crossJoin(frame.select(F.col("name").alias("with"))).where("name < with")
    sets = frame.select("name", F.array_distinct(line_dedup.shingles(F.col("line"))).alias("set"))
    for marks, words, most in ((line_dedup._line_marks(frame), line_dedup.LINE_MARKS, pairs.count() // 5), (line_dedup._marks(sets, "name"), line_dedup.MARKS, 3 * len(alike))):
        assert marks.count() == len(lines)
        kept = {tuple(r) for r in line_dedup._may_be_alike(pairs, marks, words, ("name", "with")).collect()}
        assert alike <= kept and len(kept) <= most, (len(kept), len(alike))


def test_lines_of_bands_of_any_size_are_compared(spark, monkeypatch):
    """Copies among lines that share a passage are found in bands whose pairs are compared and in those that go on to the prefix join."""
    from abacarium.llm import line_dedup

    rng = random.Random(12)
    passage = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(25))
    lines = [f"{passage} " + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60)).strip() for _ in range(20)]
    rows = [(2 * i + copy, line + "s" * copy) for i, line in enumerate(lines) for copy in (0, 1)]
    expected = {(key, (0,) * (key % 2)) for key, _ in rows}
    joined, prefix = [], line_dedup._prefix_pairs
    monkeypatch.setattr(line_dedup, "_prefix_pairs", lambda lines: joined.append(lines.count()) or prefix(lines))
    for many in (1024, 16):
        monkeypatch.setattr(line_dedup, "MANY", many)
        assert {(r["doc_id"], tuple(r["dropped"])) for r in repeated_lines(brute.docs_frame(spark, rows)).collect()} == expected
    assert len(joined) == 1
