"""Prefix trie and structure repair of conversations against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm.test_copies import counted

from abacarium.llm import prefix_trie, turn_repair
from abacarium.llm.prefix_trie import borrowed_trie
from abacarium.llm.turn_repair import damaged, repair, transfers

EXTRA = "key string, place int, node string, n int, owner string, code string"


def frame(spark, rows):
    """Conversations with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "k", 1, "x", 2, "o", "c") for r in rows], f"conv_id bigint, turn bigint, role string, text string, {EXTRA}").repartition(3)


def said(n=40, seed=1, longest=8):
    rng = random.Random(seed)
    lines = ["Yes.", "No", "Tell me more!", "what ?", "Ünïcode ok.", "", "  ", "One. Two"]
    rows = []
    for c in range(n):
        first = rng.randint(-1, 1)
        for t in range(rng.randint(1, longest)):
            rows.append((c, first + t, "user assistant system tool".split()[0 if t % 2 == 0 else 1] if rng.random() < 0.85 else rng.choice(["system", "user", "assistant", "tool", "Üser"]),
                         rng.choice(lines) + (f" {c % 4}." if rng.random() < 0.6 else "")))
    return rows


def odd_turns():
    """NULLs, repeated rows, ties, gaps, a conversation of NULLs only, long texts."""
    return [(100, None, "user", "a."), (100, None, "user", "a."), (100, 3, None, None), (100, 3, "assistant", "b."), (100, 9, "assistant", "b"),
            (101, None, None, None), (102, 0, "user", "x" * 200_000 + "."), (102, 1, "assistant", None), (103, 5, "system", "only system."),
            (104, 0, "user", ""), (104, 1, "", "no role."), (107, 4, "user", "late."), (111, 0, "assistant", "first."), (111, 1, "user", "then."), (12345678901, 0, "user", "far.")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest())):
        own[c].append((r or "", x or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path, of in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(of) - 1) * len(path[-1][1].encode()) if path else 0
    return Counter((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), kids[p], leaves[p], saved[p],
                    sha(",".join(map(str, sorted(c for c in of if built[c] == p))))) for p, of in members.items())


@pytest.mark.parametrize("rows", [said(), said(60, 2, 3), odd_turns(), [*said(30, 5, 20), *odd_turns()]])
def test_the_trie_matches_a_plain_version(spark, rows):
    found = borrowed_trie(frame(spark, [*rows, (None, 0, "user", "no id")]))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert counted(found) == trie_by_hand(rows)


def test_many_equal_and_truncated_conversations(spark, monkeypatch):
    """One conversation cut after each of its turns, and one that hundreds share; blocks of ids smaller than a group."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(12) for t in range(c)]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(300) for t in range(10)]
    assert counted(borrowed_trie(frame(spark, rows))) == trie_by_hand(rows)


def test_one_long_conversation_lies_in_many_slices(spark):
    rows = [(5, t, "user", f"{t}") for t in range(300)] + [(10, t, "user", f"{t}") for t in range(250)]
    assert counted(borrowed_trie(frame(spark, rows))) == trie_by_hand(rows)


def test_an_empty_table_has_no_nodes(spark):
    assert borrowed_trie(frame(spark, []).limit(0)).count() == 0


LETTERS = {"K": 0, "R": 3, "D": 4, "I": 3}


def repair_by_states(codes):
    """Least (cost, audit) by the states of the grammar, turn by turn; ``codes`` as the operator has them."""
    def better(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def inserted(ways):
        for _ in range(3):
            more = dict(ways)
            for state, (cost, audit) in ways.items():
                better(more, "a" if state == "u" else "u", (cost + 3, audit + "I"))
            ways = more
        return ways

    ways = {"": (0, "")}
    for code in codes:
        after = {}
        late = 3 if code.isupper() else 0
        for state, (cost, audit) in inserted(ways).items():
            better(after, state, (cost + 4, audit + "D"))
            if code != "-":
                want = "a" if state == "u" else "u"
                if code.lower() == "s" and state == "":
                    better(after, "s", (cost + late, audit + "K"))
                better(after, want, (cost + late, audit + "K") if code.lower() == want else (cost + late + 3, audit + "R"))
        ways = after
    ways = inserted(ways)
    return min(ways[s] for s in ("", "a") if s in ways)


def repair_by_search(codes, most):
    """Least (cost, audit) over all edits with up to ``most`` insertions."""
    best = None
    for edits in itertools.product(*[["D"] if c == "-" else ["D", "K", "Ru", "Ra"] for c in codes]):
        for gaps in itertools.product(range(most + 1), repeat=len(codes) + 1):
            if sum(gaps) > most:
                continue
            for inserted in itertools.product("ua", repeat=sum(gaps)):
                fill, roles, audit, cost = iter(inserted), "", "", 0
                for gap, edit, code in zip(gaps, [*edits, ""], [*codes, ""], strict=True):
                    roles += "".join(next(fill) for _ in range(gap))
                    audit += "I" * gap + edit[:1]
                    cost += 3 * gap + LETTERS.get(edit[:1], 0) + (3 if code.isupper() and edit != "D" else 0)
                    roles += edit[1:] or (code.lower() if edit == "K" else "")
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def test_alignments_match_a_search_over_all_edits():
    rng = random.Random(3)
    for _ in range(120):
        codes = "".join(rng.choice("suaxSUAX-ua") for _ in range(rng.randint(0, 3)))
        assert repair_by_search(codes, 3) == repair_by_states(codes) if len(codes) < 3 else True
        found = transfers(codes, True, True)
        assert [f[2:] for f in found] == [repair_by_states(codes)], codes
    for codes in ("u", "a", "s", "su", "-u", "uS", "xa", "aX", "-a-"):
        assert repair_by_search(codes, 3) == transfers(codes, True, True)[0][2:]


def test_alignments_of_long_conversations():
    rng = random.Random(4)
    for size in [*range(4, 30), 60, 120, 300]:
        for letters in ("ua", "uauauaUAsx-", "suaxSUAX-", "UAX-", "u"):
            codes = "".join(rng.choice(letters) for _ in range(size))
            assert transfers(codes, True, True)[0][2:] == repair_by_states(codes), codes


def repaired_by_hand(rows):
    by_id = defaultdict(list)
    for c, t, r, x in rows:
        by_id[c].append((t, " " if r is None else r, " " if x is None else x))
    out = Counter()
    for c, turns in by_id.items():
        kept = []
        for t, r, x in turns:
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            if kind:
                x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
                kept += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1].encode(), hashlib.md5(k[2].encode()).digest()))
        seen, codes, faults, numbers = set(), "", Counter(), [t for t, _, _ in kept if t is not None]
        for _, r, x in kept:
            end = x.strip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not end else "duplicate" if (r, x) in seen else "truncated" if end not in ".!?" else ""
            seen.add((r, x))
            faults[fault] += 1
            code = r[:1] if r[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else code.upper() if fault else code
        cost, audit = repair_by_states(codes)
        lines, state, at = [], "", 0
        for letter in audit:
            own = kept[at][1] if letter == "K" else "assistant" if state == "u" else "user"
            if letter != "D":
                lines.append(f"{own}:{'' if letter == 'I' else kept[at][2]}")
                state = own[0]
            at += letter != "I"
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:], strict=False)]
        out[c, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults["blank"], faults["duplicate"], faults["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines))] += 1
    return out


def fixed(spark, rows):
    conversations = frame(spark, rows)
    return repair(damaged(conversations), conversations)


@pytest.mark.parametrize("piece", [512, 3])
def test_repairs_match_a_plain_version(spark, monkeypatch, piece):
    monkeypatch.setattr(turn_repair, "PIECE", piece)
    rows = [*said(150), *odd_turns(), (None, 1, "user", "no id."), (None, None, "assistant", "none!")]
    found = fixed(spark, rows)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert counted(found) == repaired_by_hand(rows)


def test_one_long_conversation_is_repaired_in_pieces(spark):
    rows = said(1, 6, 2) + [(7, t, "user" if t % 2 else "assistant", f"turn {t}" + "." * (t % 7 > 0)) for t in range(2500)]
    assert counted(fixed(spark, rows)) == repaired_by_hand(rows)


def test_no_conversations_and_conversations_that_lost_all_turns(spark):
    empty = frame(spark, [(1, 1, "user", "a.")]).limit(0)
    assert repair(damaged(empty), empty).count() == 0
    gone = [(c, 0, "user", "a.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    assert counted(fixed(spark, gone)) == Counter({(c, 0, 0, 0, 0, 0, 0, "", sha("")): 1 for c, *_ in gone})
