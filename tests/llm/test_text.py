"""Contamination, personal data, tokens, shards against plain versions, libraries and round trips."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings, strategies as st
from llm import brute
from llm.test_copies import counted
from pyspark.sql import functions as F

from abacarium.llm import bpe, pii
from abacarium.llm.automaton import Automaton, compile_words
from abacarium.llm.bpe import Encoder, build_encoder, decode, encode, round_trip, token_lengths, word_counts
from abacarium.llm.common import vocabulary_path
from abacarium.llm.sharding import assign_shards, write_shards
from abacarium.llm.token_counts import length_histogram, length_quantiles, suffix_sums, truncated_totals
from abacarium.llm.winnow import decontaminate


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def own():
    return Encoder(Path(vocabulary_path()).read_text(encoding="utf-8"))


def test_contamination_matches_all_windows(spark):
    rng = random.Random(2)
    vocabulary = [f"t{i}" for i in range(60)] + ["ÄÖ", "x9", "don't"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 5, 12, 13, 14, 40])))) for i in range(30)]
    items += [(30, None), (31, items[4][1]), (32, "..."), (4, items[4][1]), (None, items[5][1])]
    rows = brute.odd_rows()
    for key in range(100, 160):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 200))]
        if key % 2:
            piece = (items[rng.randrange(30)][1] or "").split()
            lo = rng.randint(0, max(0, len(piece) - 13))
            text[len(text) // 2:len(text) // 2] = piece[lo:]
        rows.append((key, rng.choice([" ", ", ", "\n"]).join(text).upper()))
    benchmark = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id bigint, text string, fp bigint")
    found = decontaminate(brute.docs_frame(spark, rows), benchmark)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert counted(found) == brute.contamination(rows, items)
    assert counted(decontaminate(brute.docs_frame(spark, rows), benchmark.limit(0))) == brute.contamination(rows, [])
    assert decontaminate(brute.docs_frame(spark, []).limit(0), benchmark).count() == 0


PLAIN = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {0: True, 1: kind != 1 or all(int(p) <= 255 for p in m[0].split(".")),
                    2: 12 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0, 3: 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+ ()12345670é%_\n４", max_size=60))
def test_plain_spans_are_those_of_the_fixed_patterns(text):
    assert pii.detect(text) == plain_spans(text)


@pytest.mark.parametrize(("text", "kind", "found"), [
    ("write to john.doe [at] mail (dot) example {dot} com now", "email", "john.doe [at] mail (dot) example {dot} com"),
    ("jane at site dot org please", "email", "jane at site dot org"),
    ("аdmin@exаmple.com", "email", "аdmin@exаmple.com"),
    ("or ＋１ ５５５ ０００ １２３４.", "phone", "＋１ ５５５ ０００ １２３４"),
    ("card four one one one one one one one one one one one one one one one", "card", "four" + " one" * 15),
    ("ip １０.0.0.1 x", "ip", "１０.0.0.1"),
    ("mail john dot doe at example dot com.", "email", "john dot doe at example dot com"),
    ("or to john @ example . com now", "email", "john @ example . com"),
    ("one nine two dot one six eight dot one dot one is up", "ip", "one nine two dot one six eight dot one dot one"),
    ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("card 4l11 1111 1111 1lI1", "card", "4l11 1111 1111 1lI1"),
    ("jo\u200bhn@exa\u200bmple.com", "email", "jo\u200bhn@exa\u200bmple.com"),
    ("JANE (AT) SITE (DOT) ORG", "email", "JANE (AT) SITE (DOT) ORG"),
])
def test_disguises_are_seen_through_and_mapped_back(text, kind, found):
    spans = pii.disguised(text, pii.detect(text))
    assert [(pii.KINDS[k], text[a:b]) for a, b, k in spans] == [(kind, found)]


@pytest.mark.parametrize("text", ["He looked at the dot on the map", "one two three four", "un deux trois", "a – b", "nine at dot", "", "two plus 3", "the dot at the end", "Ill 1O1 and 2l", "see @ home . de facto", "a1 at 2 dot three"])
def test_clean_texts_are_left_alone(text):
    assert pii.disguised(text, pii.detect(text)) == []


@pytest.mark.parametrize("text, kind, found", [
    ("call plus 49 170 1234567 now", "phone", "plus 49 170 1234567"),
    ("card 4111-l111-1111-1111", "card", "4111-l111-1111-1111"),
    ("card 4OO0 0000 0000 0002", "card", "4OO0 0000 0000 0002"),
    ("tel=plus one two three four five six seven eight nine!", "phone", "plus one two three four five six seven eight nine"),
])
def test_disguises_without_any_other_clue(text, kind, found):
    assert [(pii.KINDS[k], text[a:b]) for a, b, k in pii.disguised(text, pii.detect(text))] == [(kind, found)]


@pytest.mark.parametrize("text, found", [
    ("аdmin@example.com", "аdmin@example.com"), ("mail jo\u200bhn@example.com now", "jo\u200bhn@example.com"),
    ("plain a@b.org and аdmin@example.com", "аdmin@example.com"),
])
def test_a_disguise_in_the_local_part_alone(text, found):
    base = pii.detect(text)
    assert base and [(k, text[a:b]) for a, b, k in pii.disguised(text, base)] == [(0, found)]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([
    "plus", "one", "TWO", "ſix", "NİNE", "fünf", "dot", "at", "a", "com", "x", "O", "l", "I", "0", "4", "17", " ", " ", "  ", "\n", ".", "-", ",", "@",
    "[at]", "(DOT)", "{poİnt}", "<", ">", "_", "=", "*", "+", "é", "\u200b", "а"]), max_size=14).map("".join))
def test_every_rewritten_text_has_a_clue(text):
    tape = pii.Tape(text)
    for step in (pii.homoglyphs, pii.spelled_digits, pii.signs):
        step(tape)
    assert tape.text == text or pii._clue(text)


def test_personal_data_rows(spark):
    rows = [*brute.odd_rows(), (50, "a@b.c and me [at] b (dot) org"), (51, "1." * 50_000), (52, "+" + "1 " * 50_000), (53, "a" * 200_000)]
    got = {(r["doc_id"], r["base_sha256"]): r for r in pii.find_personal(brute.docs_frame(spark, rows)).collect()}
    for d, t in rows:
        base = "" if d == 53 else pii.spans_text(plain_spans(t or ""))  # the fixed patterns need quadratic time on the last
        assert (d, hashlib.sha256(base.encode()).hexdigest()) in got
    mail = next(r for (d, _), r in got.items() if d == 50)
    assert (mail["n_email"], mail["spans"], mail["base_spans"]) == (2, "email:0:5,email:10:29", "email:0:5")


def test_lexicon_numbers_and_outputs():
    words = sorted({f"{a}{b}{c}".encode() for a in ("th", "w", "") for b in ("e", "an", "är") for c in ("", "s", "ing")})
    lexicon = Automaton(compile_words((w, [i, i + 1][: i % 3]) for i, w in enumerate(words)))
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    assert [lexicon.output(i) for i in range(len(words))] == [[i, i + 1][: i % 3] for i in range(len(words))]
    assert lexicon.numbers([b"", b"x", b"th", b"thesx", b"wings"]).tolist() == [-1] * 5
    assert len(lexicon.final) < 20, "common endings are shared"


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("theTHE'sd!?., 19\n\t\x1cñéΣİß日😀́½"), st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"])), max_size=50))
def test_encoding_equals_the_library(text, library, own):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_and_special_tokens(library, own):
    for text in ("U\u0330\u0300", "\u023a\u023eb", "\u1e9e", "\u212a\u212b", "ab" * 4000 + "the" * 500, "a<|endoftext|>B <|startoftext|>", "|" * 300, "", "Σ" * 99):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_words_merged_together_are_those_merged_alone(own, monkeypatch):
    rng = random.Random(7)
    words = [bytes(rng.choices(b"theandsingro\xc3\xa9!", k=rng.randint(1, 90))) for _ in range(3000)] + [b"the", b"x"] * 40 + [bytes([b]) for b in range(256)]
    expected = [own.merge(w) for w in words]
    alone = []
    monkeypatch.setattr(own, "merge", lambda word, merge=own.merge: alone.append(word) or merge(word))
    assert own.merge_all(words) == expected
    assert all(len(w) > 64 for w in alone), "only long words go one by one"
    assert own.merge_all([b"the"]) == [expected[words.index(b"the")]] and own.merge_all([]) == []


def test_words_of_the_lexicon_stay_when_others_are_forgotten(library, monkeypatch):
    monkeypatch.setattr(bpe, "_KEEP", 20)
    vocabulary = Path(vocabulary_path()).read_text(encoding="utf-8")
    listed, merge = [b"cat", b"the"], Encoder(vocabulary).merge
    own = Encoder(vocabulary, compile_words((w, merge(w)) for w in listed))
    rng = random.Random(8)
    for _ in range(30):
        values = [" ".join(["the cat", *("".join(rng.choices("abcdé!", k=5)) for _ in range(rng.randint(0, 9))), "<|endoftext|>"]) for _ in range(3)]
        for value, found in zip(values, own.entries(values), strict=True):
            ids = library.encode(value, add_special_tokens=False).ids
            assert own.ids(found).tolist() == ids
            assert own.joined(own.as_numbers, found) == " ".join(map(str, ids))
            assert sum(own.sizes[i] for i in found) == len(ids)
        assert len(own.known) <= 20 + 100 and {"the", "cat"} <= own.kept.keys() <= own.known.keys()


def test_a_worker_remembers_few_rare_words(library):
    """Entries of words outside the lexicon take memory in every worker of an executor."""
    own, rng = Encoder(Path(vocabulary_path()).read_text(encoding="utf-8")), random.Random(6)
    for _ in range(16):
        values = [" ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(60)) for _ in range(100)]
        found = own.entries(values)
        assert len(own.known) - len(own.kept) <= 80_000 and len(own.sizes) == len(own.known)
        assert own.ids(found[7]).tolist() == library.encode(values[7], add_special_tokens=False).ids


def test_counting_builds_no_merges(own):
    class Shared:
        value = {"vocabulary": own.source, "lexicon": None}

    splitter = bpe.splitter_of(Shared)
    assert splitter is bpe.splitter_of(Shared) and not hasattr(splitter, "merges")
    for text in ("Don't stop, NOW 12\u00e9", "日本 the\u3000cat", ""):
        assert splitter.words(text) == own.words(text)


def test_words_are_counted_as_the_splitter_finds_them(spark, own):
    spaces = "".join(map(chr, range(0x21))) + "\x7f\x85\xa0"
    values = [*(f"Don't{c}stop, NOW{c}'re ye'll 12{c}é{c}\u0301x" for c in spaces), "日本 the\u3000cat <|endoftext|>the", "", None]
    docs = brute.docs_frame(spark, list(enumerate(values)))
    expected = Counter(w for v in values for p in own.cut.split(v or "") if p not in own.special for w in own.words(p))
    shared = spark.sparkContext.broadcast({"vocabulary": own.source, "lexicon": None})
    assert {r["word"]: r["n"] for r in word_counts(docs, shared).collect()} == expected


def test_encode_decode_and_round_trip(spark, library):
    rows = [*brute.odd_rows(), *((60 + i, "the cat and the hat " * 20) for i in range(9))]
    docs = brute.docs_frame(spark, rows)
    shared = build_encoder(docs, vocabulary_path(), size=5)
    expected = Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected[d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert counted(round_trip(docs, shared)) == expected
    ids = encode(docs, shared)
    back = {r["doc_id"]: r["text"] for r in decode(ids, shared).collect()}
    assert back[60] == library.decode(library.encode("the cat and the hat " * 20, add_special_tokens=False).ids, skip_special_tokens=False)
    assert counted(token_lengths(docs, shared)) == counted(ids.select("doc_id", "n_tokens"))
    nothing = docs.limit(0)
    assert round_trip(nothing, build_encoder(nothing, vocabulary_path())).count() == 0


def test_token_totals_for_every_limit(spark):
    rng = random.Random(3)
    lengths = [0, 0, 5, 9000, 20_000] + [rng.randint(0, 300) for _ in range(400)]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)] + [(999, None)], "doc_id bigint, n_tokens bigint")
    lengths.append(0)
    sums = suffix_sums(length_histogram(frame))
    for r in sums.collect():
        limit = r["length"]
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_from"] == sum(n >= limit for n in lengths)
        assert r["tokens_from"] == sum(n for n in lengths if n >= limit)
        assert r["tokens_cut"] == sum(min(n, limit) for n in lengths)
        assert (r["docs_total"], r["tokens_total"]) == (len(lengths), sum(lengths))
    limits = [0, 1, 7, 128, 9000, 9001, 10**6]
    assert counted(truncated_totals(sums, limits)) == Counter(
        (c, sum(min(n, c) for n in lengths), sum(n > c for n in lengths)) for c in limits)
    shares = [0.01, 0.5, 0.99, 1.0]
    ordered = sorted(lengths)
    assert counted(length_quantiles(sums, shares)) == Counter((s, ordered[math.ceil(s * len(ordered)) - 1]) for s in shares)
    assert suffix_sums(length_histogram(frame.limit(0))).count() == 0


def shards_by_hand(rows, limit):
    parts = []
    for d, t in rows:
        digest = hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15]
        parts.append((d, len((t or "").encode()), f"{int(digest, 16):060b}"))
    out = Counter()
    for d, size, bits in parts:
        for depth in range(61):
            own = [p for p in parts if p[2][:depth] == bits[:depth]]
            total = sum(p[1] for p in own)
            if total <= limit or depth == 60:
                out[d, size, depth, bits[:depth], total, len(own), total <= limit] += 1
                break
    return out


@pytest.mark.parametrize("limit", [10, 300, 10**9])
def test_shards_fit_and_match_a_plain_directory(spark, limit):
    rows = [(i, "é" * (i % 17)) for i in range(150)] + [(None, "ab"), (None, None), (7, "x" * 40), (200, "")]
    found = assign_shards(brute.docs_frame(spark, rows), limit)
    assert counted(found) == shards_by_hand(rows, limit)
    assert assign_shards(brute.docs_frame(spark, []).limit(0), limit).count() == 0


def test_shards_are_written_whole(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * 30) for i in range(80)], "doc_id bigint, text string")
    write_shards(docs, 300, str(tmp_path / "out"))
    back = spark.read.option("basePath", str(tmp_path / "out")).schema("doc_id bigint, text string, shard string").parquet(str(tmp_path / "out"))
    assert counted(back.select("doc_id", "text")) == counted(docs)
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).agg(F.max("b")).first()[0] <= 300


def test_shards_are_written_with_clashing_columns_and_documents_above_the_limit(spark, tmp_path):
    rows = [(i, "y" * 50, "own", 1) for i in range(40)] + [(100, "z" * 400, "own", 1) for _ in range(30)] + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, _key int").repartition(3)
    path, merge = str(tmp_path / "out"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # which would make one task of so few rows
    try:
        assert write_shards(docs, 500, path) == "_shard"
    finally:
        spark.conf.unset(merge)
    back = spark.read.option("basePath", path).schema("doc_id bigint, text string, shard string, _key int, _shard string").parquet(path)
    assert counted(back.drop("_shard")) == counted(docs)
    large = back.where("doc_id = 100")
    assert large.select("_shard").distinct().count() == 1 and large.select(F.input_file_name()).distinct().count() > 1


#: The bare addresses as one pattern, which tries every word as a beginning.
_WHOLE = re.compile(
    rf"(?i)(?<![\w.@%+-])[a-z0-9._%+-]+(?:\s{{1,2}}dot\s{{1,2}}[a-z0-9_%+-]+)*(?P<at>\s{{1,2}}at\s{{1,2}}|@)[a-z0-9-]+"
    rf"(?:(?:\s{{1,2}}dot\s{{1,2}}|\.)[a-z0-9-]+)*(?:\s{{1,2}}dot\s{{1,2}}|\.)(?:{pii._ENDINGS})(?![\w-])")


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "x-y", "at", "dot", "com", "de", "@", ".", " ", "  ", " at ", " dot ", "é", "_", "%", "info", "AT", "Dot"]), max_size=24))
def test_bare_addresses_are_those_of_the_whole_pattern(parts):
    for text in ("".join(parts), " ".join(parts)):
        assert list(pii.bare_addresses(text)) == [(m.start(), m.end(), m.span("at")) for m in _WHOLE.finditer(text)]


@pytest.mark.parametrize("part", ["a dot ", "a at ", "dot ", "a@", "at dot ", "a at b dot "])
def test_a_megabyte_of_disguises_takes_no_time(part):
    text = part * (1_000_000 // len(part))
    began = time.time()
    list(pii.bare_addresses(text))
    assert time.time() - began < 5
