"""Plain-Python versions of the operators and the small tables that the tests share."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names that operators might use inside.
EXTRA = "key bigint, n bigint, score double, row bigint, lang string, shard string, line string, sid string"


def docs_frame(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame(
        [(d, t, 1, 2, 0.5, 3, "xx", "s", "l", "q") for d, t in rows], f"doc_id bigint, text string, {EXTRA}").repartition(3)


def odd_rows():
    """NULLs, empty texts, white space, ties, repeats, one very long text."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  two"), (6, "one"), (7, long), (8, long + " end"),
            (9, "a b c d e"), (9, "a b c d e"), (10, "A B c d e"), (None, "a b c d e"), (11, "日本語 テキスト ß ſ"), (12, None)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, n=3):
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def similar(rows, percent=90):
    sets = [(d, shingles(t)) for d, t in rows]
    links = Union()
    for i, (_, a) in enumerate(sets):
        links.root(i)
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.join(i, j)
    low = {}
    for i, (d, _) in enumerate(sets):
        r = links.root(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return Counter((d, len(s), low.get(links.root(i)) if s else d) for i, (d, s) in enumerate(sets))


def near_copies(seed=1, groups=6, size=14, length=120):
    """Groups around a base text with a few changed words, chains of small steps, unrelated texts, a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(900)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(50))
    rows, key = [], 0
    for group in range(groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        step = list(base)
        for copy in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(length)] = rng.choice(vocabulary)
            if group % 2:
                step[rng.randrange(length)] = rng.choice(vocabulary)
                own = list(step)
            rows.append((key, " ".join(own)))
            key += 1
    for _ in range(20):
        rows.append((key, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 150))) + " " + passage))
        key += 1
    rng.shuffle(rows)
    return rows


def exact(rows):
    clean = [(d, t or "", re.sub(r"[\x20\x09-\x0D]", "", t or "")) for d, t in rows]
    big = 1 << 64
    best, size = {}, Counter()
    for d, t, body in clean:
        size[body] += 1
        rank = (-len(t), big if d is None else d)
        best[body] = min(best.get(body, rank), rank)
    keep = {b: None if r[1] == big else r[1] for b, r in best.items()}
    return Counter((d, keep[b], size[b], d == keep[b], hashlib.sha256(b.encode()).hexdigest()) for d, _, b in clean)


def contamination(rows, items):
    rule = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = rule.findall((text or "").translate(LOWER))
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = Counter()
    for d, text in rows:
        w = rule.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i:i + size]))
                if own:
                    hit |= set(range(i, i + size))
                    found |= own
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out[d, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(ids.encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(w)] += 1
    return out
