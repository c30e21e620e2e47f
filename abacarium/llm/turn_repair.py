"""Repair of conversations whose turns break the order system, user, assistant, user, ...

1. Turns are numbered within their conversation by running sums over slices, and
   repeated turns are found by an aggregate per conversation, role and digest of the
   text. Each turn becomes one letter, and letters are packed into pieces of
   ``PIECE`` turns, so that no task holds a conversation, however long.
2. Wagner-Fischer target alignment: a piece is aligned to every feasible length of the
   grammar string, that is to every suffix of ``...uaua``, in one table over turns and
   letters that remain; a leading system turn is tried at every place. The band is
   Ukkonen's, from the incumbent cost: the cost of an alignment that takes every
   misplaced turn by an insertion bounds how many insertions and deletions can pay off.
3. Among alignments of the least cost, the audits traced back for all lengths are
   compared, and the least one stays.
4. Pieces of one long conversation are aligned for every state of the grammar in which
   they may begin and end. A fold over their costs and the order of their audits, a few
   numbers per piece, picks the states; no audit of such alignments is the beginning of
   another one, so the least audit of the whole is put together from least audits.
5. The repaired text is hashed turn by turn as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from abacarium.llm.common import by_value, small_batches, stored
from abacarium.operators.ordering import running_sums

PIECE = 512
#: What edits cost, and a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_FAR = 1 << 40
#: States: nothing yet, after system, after user, after assistant; and the end of the conversation.
START, S, U, A, END = range(5)
_NOTHING = hashlib.sha256(b"").hexdigest()


class Table:
    """Least costs of aligning the turns from any place on to the last ``k`` letters of the grammar string.

    ``codes`` has a letter per turn: its role's initial (``s``, ``u``, ``a`` or ``x``), a
    capital if it is truncated, or ``-`` if it has to go. The string ends in ``last``;
    letters may follow the last turn only if ``open_end``. Costs leave out what every
    alignment pays. Only cells that an alignment of cost ``limit`` can pass are right.
    """

    def __init__(self, codes: str, last: str, open_end: bool, limit: int):
        self.codes, n = codes, len(codes)
        self.stay = [c != "-" for c in codes]
        #: A truncated turn pays three if it stays, so that its deletion costs one more.
        self.drop = [0 if c == "-" else DELETE - TRUNCATED if c.isupper() else DELETE for c in codes]
        cheap = sum(c.isupper() for c in codes)
        out = min(limit // (DELETE - TRUNCATED), cheap)
        out += max(0, limit - cheap * (DELETE - TRUNCATED)) // DELETE
        self.low, high = -min(out, sum(self.stay)), limit // INSERT + 1
        offset = np.arange(self.low, high + 1)
        self.width, self.last = len(offset), last
        self.left = [0] * (n + 1)
        self.rows: list[np.ndarray] = [np.empty(0)] * (n + 1)
        here = np.where(offset == 0, 0, INSERT * offset if open_end else _FAR)
        self.rows[n] = np.where(offset < 0, _FAR, here)
        slope = INSERT * np.arange(self.width)
        want = np.array([_other(last), last])  # by the parity of the letters that remain
        for i in range(n - 1, -1, -1):
            after, code = self.rows[i + 1], codes[i].lower()
            self.left[i] = self.left[i + 1] + self.stay[i]
            remain = offset + self.left[i]
            if self.stay[i]:
                here = np.append(after[1:], _FAR) + self.drop[i]
                take = after + np.where(want[remain & 1] == code, 0, REROLE)
                here = np.minimum(here, np.where(remain >= 1, take, _FAR))
            else:
                here = after
            here = np.minimum.accumulate(here - slope) + slope
            self.rows[i] = np.where(remain < 0, _FAR, np.minimum(here, _FAR))

    def cost(self, i: int, k: int) -> int:
        at = k - self.left[i] - self.low
        return int(self.rows[i][at]) if 0 <= at < self.width else _FAR

    def lengths(self, i: int) -> range:
        """The remaining lengths inside the band at turn ``i``."""
        low = self.left[i] + self.low
        return range(max(0, low), low + self.width)

    def trace(self, i: int, k: int) -> str:
        """The least audit of the least cost from turn ``i`` on: at every step the first letter that leads to it."""
        out, n = [], len(self.codes)
        while i < n or k:
            cost = self.cost(i, k)
            if i < n and self.drop[i] + self.cost(i + 1, k) == cost:
                out.append("D")
                i += 1
            elif k and INSERT + self.cost(i, k - 1) == cost:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.codes[i].lower() == (self.last if k & 1 else _other(self.last)) else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _other(letter: str) -> str:
    return "u" if letter == "a" else "a"


def _incumbent(codes: str, last: str, open_end: bool) -> int:
    """The cost of one alignment: from the end, every turn that does not fit gets a letter inserted after it."""
    cost, want = 0, last
    fresh = not open_end
    for code in reversed(codes):
        if code == "-":
            continue
        low = code.lower()
        if low == want:
            want = _other(want)
        elif low in "ua" and not fresh:
            cost += INSERT
        else:
            cost += REROLE
            want = _other(want)
        fresh = False
    # An odd letter in front, or two of them where nothing stays.
    return cost + 2 * INSERT


def transfers(codes: str, first: bool, final: bool) -> list[tuple[int, int, int, str]]:
    """``(begin, end, cost, audit)`` of the best alignment of a piece for all states that it may begin and end in.

    The first piece begins with nothing; the final one ends the conversation.
    """
    base = sum(0 if c == "-" else TRUNCATED if c.isupper() else 0 for c in codes) + DELETE * codes.count("-")
    begins = (START,) if first else (START, S, U, A)
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(begin: int, end: int, cost: int, audits) -> None:
        key = begin, END if final and end in (START, A) else end
        if final and end not in (START, A) or cost >= _FAR:
            return
        if key not in best or cost < best[key][0]:
            best[key] = cost, audits()
        elif cost == best[key][0]:
            best[key] = cost, min(best[key][1], audits())

    drops = [0 if c == "-" else DELETE - TRUNCATED if c.isupper() else DELETE for c in codes]
    none, n = sum(drops), len(codes)
    systems = [i for i, c in enumerate(codes) if c in "sS"]
    # Nothing of the piece stays, or one system turn alone.
    for begin in begins:
        if begin in (START, S):
            offer(begin, begin, none, lambda: "D" * n)
    if not final:
        for i in systems:
            offer(START, S, none - drops[i], lambda i=i: "D" * i + "K" + "D" * (n - i - 1))
    for end, last in ((A, "a"),) if final else ((A, "a"), (U, "u")):
        table = Table(codes, last, final, _incumbent(codes, last, final))
        #: Remaining lengths of this parity begin with a user turn.
        even = 0 if end == A else 1
        for begin in begins:
            parity = even if begin != U else 1 - even
            fits = [k for k in table.lengths(0) if k % 2 == parity and (k or begin == end)]
            _best_of(offer, begin, end, [(table.cost(0, k), 0, k) for k in fits], table)
            if begin == START:
                ahead = 0
                for i in range(n):
                    if codes[i] in "sS":
                        fits = [k for k in table.lengths(i + 1) if k and k % 2 == even]
                        _best_of(offer, begin, end, [(ahead + table.cost(i + 1, k), i + 1, k) for k in fits], table, "D" * i + "K")
                    ahead += drops[i]
    return [(begin, end, base + cost, audit) for (begin, end), (cost, audit) in sorted(best.items())]


def _best_of(offer, begin: int, end: int, found: list[tuple[int, int, int]], table: Table, front: str = "") -> None:
    """Offer the alignments of least cost; only their audits are traced."""
    if found:
        least = min(cost for cost, _, _ in found)
        for cost, i, k in found:
            if cost == least:
                offer(begin, end, cost, lambda i=i, k=k: front + table.trace(i, k))


def _aligned(pieces: DataFrame) -> DataFrame:
    """``begin``, ``end``, ``cost``, ``rank`` (by audit, among those of one beginning) and ``audit`` for every piece."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, bool, bool], list] = {}
        for batch in source:
            rows = []
            for key, piece, last, codes in zip(*(batch.column(c).to_pylist() for c in ("key", "piece", "pieces", "codes")), strict=True):
                final = piece + 1 == last
                # Short conversations repeat; long ones are not kept.
                mark = codes, piece == 0, final
                found = known.get(mark)
                if found is None:
                    found = transfers(*mark)
                    if len(codes) <= 16 and len(known) < 100_000:
                        known[mark] = found
                order = {a: r for r, a in enumerate(sorted(f[3] for f in found))}
                rows += [(key, piece, b, e, cost, order[a], a) for b, e, cost, a in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string()))],
                ["key", "piece", "begin", "end", "cost", "rank", "audit"])

    return pieces.select("key", "piece", "pieces", "codes").mapInArrow(
        run, "key string, piece bigint, begin int, end int, cost bigint, rank int, audit string")


def _chosen(aligned: DataFrame) -> DataFrame:
    """Of every piece of the conversations with several, the alignment on the path of least cost and least audit.

    A task holds four numbers for each way through a piece, about one byte a turn.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = []
            for key, ways in zip(batch.column("key").to_pylist(), batch.column("ways").to_pylist(), strict=True):
                pieces: dict[int, list[tuple[int, int, int, int]]] = {}
                for way in ways:
                    pieces.setdefault(way["piece"], []).append((way["begin"], way["end"], way["cost"], way["rank"]))
                to_go, step = {END: 0}, {}
                for piece in sorted(pieces, reverse=True):
                    here: dict[int, tuple[int, int, int]] = {}
                    for begin, end, cost, rank in pieces[piece]:
                        if end in to_go:
                            here[begin] = min(here.get(begin, (_FAR, 0, 0)), (cost + to_go[end], rank, end))
                    step[piece] = {begin: end for begin, (_, _, end) in here.items()}
                    to_go = {begin: total for begin, (total, _, _) in here.items()}
                state = START
                for piece in sorted(pieces):
                    rows.append((key, piece, state, step[piece][state]))
                    state = step[piece][state]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32()))], ["key", "piece", "begin", "end"])

    ways = aligned.groupBy("key").agg(F.collect_list(F.struct("piece", "begin", "end", "cost", "rank")).alias("ways"))
    return ways.mapInArrow(run, "key string, piece bigint, begin int, end int")


def _hashed(turns: DataFrame) -> DataFrame:
    """``key``, ``repaired_sha256`` from turns with their ``edit`` (letters of the audit, insertions included)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, digest, empty = None, START, None, True
        for batch in source:
            out = []
            for key, edit, role, text in zip(*(batch.column(c) for c in ("key", "edit", "role", "text")), strict=True):
                key = key.as_py()
                if key != last:
                    if last is not None:
                        out.append((last, digest.hexdigest()))
                    last, state, digest, empty = key, START, hashlib.sha256(), True
                for letter in edit.as_py():
                    if letter == "D":
                        continue
                    own = role.as_py() if letter == "K" else "assistant" if state == U else "user"
                    state = S if state == START and own[:1] == "s" else A if state == U else U
                    digest.update(b"" if empty else b"\n")
                    digest.update(own.encode() + b":")
                    if letter != "I":
                        digest.update(text.as_py().encode("utf-8", "surrogatepass"))
                    empty = False
            yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in out], pa.string()), "repaired_sha256": pa.array([s for _, s in out], pa.string())})
        if last is not None:
            yield pa.RecordBatch.from_pydict({"key": [last], "repaired_sha256": [digest.hexdigest()]})

    laid = turns.repartition("key").sortWithinPartitions("key", "place").select("key", "edit", "role", "text")
    return laid.mapInArrow(run, "key string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """A test feed: one turn in four with a fault, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops it, 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes it a user turn. NULLs count as one space.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("said", "[.!?]", "")).otherwise(F.col("said"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("by"), spaced("text").alias("said"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("by")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def repair(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``ids``: its faults, and the cheapest repair of its turns.

    ``turns``: ``conv_id``, ``turn``, ``role``, ``text``; taken by turn, NULL first, ties
    by role and a digest of the text. ``gaps``: turn numbers missing between the least
    and the greatest. The first fault of a row counts: ``blank`` (white space only),
    ``duplicate`` (role and text seen earlier), ``truncated`` (no full stop, exclamation
    or question mark at the end). ``illegal``: neighbours whose roles may not follow one
    another. ``cost`` and ``audit`` are those of the cheapest edits (K keep, R new role,
    D delete, I insert) that lead to ``(s?(ua)+)?``, blank and repeated rows deleted;
    of equally cheap ones the audit that sorts first. ``repaired_sha256`` is taken of
    the repaired ``role:text`` lines.

    NULL roles and texts count as one space; a role that is empty or begins with another
    letter can only get a new role or go. NULL ids are one conversation. An id without
    turns has zeros, an empty audit and the digest of nothing; no ids, no rows. Other
    columns are ignored.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    held = stored(turns.select(
        spaced("conv_id").alias("key"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"),
        F.monotonically_increasing_id().alias("at")), "turns")
    end = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    small = held.select(
        "key", "turn", "role", "at", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.when(end == "", "b").when(~end.isin(".", "!", "?"), "t").otherwise("").alias("fault"))
    placed = running_sums(small, ["key"], [F.col("turn").asc_nulls_first(), "role", "digest", "at"], {"place": F.lit(1)})
    placed = stored(placed.withColumn("place", F.col("place").cast("long")), "placed")
    earliest = placed.where("fault <> 'b'").groupBy("key", "role", "digest").agg(F.min("place").alias("earliest"))
    marked = placed.join(earliest, ["key", "role", "digest"], "left")
    repeated = F.col("place") > F.col("earliest")
    fault = F.when(F.col("fault") == "b", "b").when(repeated, "d").otherwise(F.col("fault"))
    code = F.when(fault.isin("b", "d"), "-").when(fault == "t", F.upper("initial")).otherwise(F.col("initial"))
    marked = stored(marked.select("key", "turn", "at", "place", "initial", fault.alias("fault"), code.alias("code")), "marked")

    cut = F.floor((F.col("place") - 1) / PIECE).cast("long")
    letters = F.sort_array(F.collect_list(F.struct("place", "code", "initial")))
    pieces = marked.groupBy("key", cut.alias("piece")).agg(letters.alias("letters")).select(
        "key", "piece", F.array_join(F.col("letters.code"), "").alias("codes"), F.array_join(F.col("letters.initial"), "").alias("initials"))
    counts = marked.groupBy("key").agg(
        F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("different"), F.max("place").alias("rows"),
        *[F.count_if(F.col("fault") == letter).alias(name) for name, letter in (("blank", "b"), ("duplicate", "d"), ("truncated", "t"))])
    counts = stored(counts.withColumn("pieces", F.floor((F.col("rows") + PIECE - 1) / PIECE).cast("long")), "counts")
    pieces = stored(pieces.join(counts.select("key", "pieces"), "key"), "pieces")

    aligned = stored(_aligned(pieces), "aligned")
    several = counts.where("pieces > 1").select("key")
    ways = _chosen(aligned.join(several, "key", "left_semi"))
    audits = aligned.join(several, "key", "left_anti").unionByName(aligned.join(ways, ["key", "piece", "begin", "end"], "left_semi"))
    audits = stored(audits.select("key", "piece", "cost", "audit"), "audits")

    # Neighbours inside a piece, then across pieces.
    pairs = F.transform(F.sequence(F.lit(1), F.length("initials") - 1), lambda i: F.substring("initials", i, F.lit(2)))
    wrong = F.when(F.length("initials") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    along = Window.partitionBy("key").orderBy("piece")
    seam = F.concat(F.lag(F.substring("initials", -1, 1)).over(along), F.substring("initials", 1, 1))
    illegal = pieces.select("key", wrong.alias("inside"), seam.alias("seam")).groupBy("key").agg(
        (F.sum("inside") + F.count_if(F.col("seam").isNotNull() & ~F.col("seam").isin("su", "ua", "au"))).alias("illegal"))
    whole = audits.groupBy("key").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda p: p.getField("audit")), "").alias("audit"))

    # One token a turn: insertions before it, its edit, and after the last turn the insertions that follow.
    tokens = audits.select("key", F.posexplode(F.regexp_extract_all("audit", F.lit("I*[DKR](?:I+$)?"), F.lit(0))).alias("i", "edit"), "piece")
    tokens = tokens.where("edit <> 'D'").select("key", (F.col("piece") * PIECE + F.col("i") + 1).alias("place"), "edit")
    edits = marked.select("key", "place", "at").join(tokens, ["key", "place"]).select("at", "place", "edit")
    digests = _hashed(small_batches(held).join(edits, "at").select("key", "place", "edit", "role", "text"))

    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("key", spaced("conv_id"))
    out = every.join(counts, "key", "left").join(illegal, "key", "left").join(whole, "key", "left").join(digests, "key", "left")
    gaps = F.col("high") - F.col("low") + 1 - F.col("different")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in (
        ("gaps", gaps), *[(n, F.col(n)) for n in ("blank", "duplicate", "truncated", "illegal", "cost")])],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(_NOTHING)).alias("repaired_sha256"))


by_value(__name__)
