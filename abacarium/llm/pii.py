"""Personal data in plain and in disguised form, with positions in the original text.

Plain spans are found on the text as it is. Then small transducers rewrite it:
homoglyphs and full-width forms to ASCII, digits spelled out in words to digits,
``[at]``/``(dot)`` and the like to signs. Each writes, next to every character it
puts out, the stretch of the source that it stands for. The same detectors run on
the rewritten text, and what they find is mapped back to code points of the source.
Only texts with something to rewrite go through this second step.

Detectors start at characters that every match must have (an at sign, the start of
a run of digits, a plus), so their work stays linear for runs of any length.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from abacarium.llm.common import by_value, small_batches, texts

KINDS = ("email", "ip", "card", "phone")

# --- detectors (fixed patterns) -------------------------------------------------------------
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def detect(text: str) -> list[tuple[int, int, int]]:
    """Start, end and kind of every span, leftmost and without overlap per kind, sorted."""
    out = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if len(m[0]) <= 40 and 12 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out)


# --- transducers ----------------------------------------------------------------------------
#: A letter or sign and the ASCII one that it looks like.
_LOOK = {ord(pair[0]): pair[1] for pair in (
    "аa еe оo рp сc уy хx іi кk мm тt вb нh јj ѕs ԁd һh ӏl АA ЕE ОO РP СC УY ХX ІI КK МM ТT ВB НH Јj Ѕs "
    "αa εe οo ρp τt υu νv κk ιi ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ‐- ‑- ‒- –- —- −- ․. 。."
).split()}
#: Digits as words.
_SPELLED = {
    word: str(digit)
    for digit, words in enumerate((
        "zero null cero zéro oh", "one eins uno", "two zwei dos deux", "three drei tres trois", "four vier cuatro quatre",
        "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf"))
    for word in words.split()
}
#: Letters that a pattern without regard to case takes for i and s.
_CASES = str.maketrans("İıſ", "iis")
_NUMBER = "|".join(sorted(_SPELLED, key=len, reverse=True))
#: Two or more spelled digits in a row, with at most blanks, hyphens or dots between them, or next to written digits.
_RUN = re.compile(rf"(?i)(?<!\w)(?:(?:{_NUMBER})(?:[ .,-]{{1,2}}(?=(?:{_NUMBER}|[0-9])(?!\w)))?){{3,}}(?!\w)|(?<!\w)(?:{_NUMBER})(?!\w)(?=[ -]?[0-9])|(?<=[0-9] )(?:{_NUMBER})(?!\w)")
_ONE = re.compile(rf"(?i)(?:{_NUMBER})(?!\w)")
#: A spelled digit next to the word dot, as in addresses of machines; the word itself between digits.
_BY_DOT = re.compile(rf"(?i)(?<!\w)(?:{_NUMBER})(?=\s{{1,2}}dot\s)|(?<=\bdot\s)(?:{_NUMBER})(?!\w)")
_DIGIT_DOT = re.compile(r"(?i)(?<=[0-9])\s{1,2}dot\s{1,2}(?=[0-9])")
_PLUS = re.compile(r"(?i)(?<!\w)plus\s?(?=[0-9])")
#: Letters that stand for digits between digits.
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl](?=[0-9OoIl -])|(?<=[0-9OoIl -])[OoIl](?=[0-9])")
_SIGN = re.compile(
    r"(?i)(?<=[\w-])\s{0,3}(?:[\[({<]\s{0,2}(?P<at>at|arroba|ät|arobase|@)\s{0,2}[\])}>]|[\[({<]\s{0,2}(?P<dot>dot|punkt|punto|point|\.)\s{0,2}[\])}>])\s{0,3}(?=[\w-])"
)
#: Domain endings that the bare words must lead to.
_ENDINGS = "com|org|net|edu|gov|int|mil|info|biz|io|ai|app|dev|co|eu|uk|us|de|fr|es|it|nl|ch|at|be|test|example|local|invalid"
#: The bare words, only where a whole address of that form stands: name at host dot ending.
_AT = re.compile(r"(?i)\s{1,2}at\s{1,2}|@")
_HOST = re.compile(rf"(?i)[a-z0-9-]+(?:(?:\s{{1,2}}dot\s{{1,2}}|\.)[a-z0-9-]+)*(?:\s{{1,2}}dot\s{{1,2}}|\.)(?:{_ENDINGS})(?![\w-])")
_NAME_CHAR = re.compile(r"(?i)[a-z0-9._%+-]")
_BEFORE_NAME = re.compile(r"[\w.@%+-]")
_DOT_BEFORE = re.compile(r"(?i)\s{1,2}dot\s{1,2}\Z")
#: An address with blanks around its signs; only endings that are no words of a language.
_SPACED = re.compile(
    rf"(?i)(?<![\w.@%+-])[a-z0-9._%+-]+(?P<at>\s{{1,2}}@\s{{0,2}}|@\s{{1,2}})[a-z0-9-]+(?:\s{{0,2}}\.\s{{0,2}}[a-z0-9-]+)*\s{{0,2}}\.\s{{0,2}}(?:com|org|net|edu|gov|io|info|biz)(?![\w-])")
_SPACED_DOT = re.compile(r"\s{1,2}\.\s{0,2}|\.\s{1,2}")
_DOT = re.compile(r"(?i)\s{1,2}dot\s{1,2}")
_ODD = re.compile("[^\x00-\x7f\xa1-ɏ‘-‟]")
_BRACKET = re.compile(r"(?i)[\[({<]\s{0,2}(?:at|dot|arroba|ät|arobase|punkt|punto|point|@|\.)\s{0,2}[\])}>]")
#: What every match of _BY_DOT and _DIGIT_DOT and every edit of a bare address holds; then what every match of _SPACED holds.
_DOT_WORD = re.compile(r"(?i)\bdot\s")
_SPARSE = re.compile(r"\s@|@\s")
#: Each transducer's pattern, or one that matches wherever it does. A text without any is left
#: as it is by the first step that might change it, hence by all.
_CLUES = (_ODD, _SPARSE, _LETTER_DIGIT, _BRACKET, _DOT_WORD, _PLUS, _RUN)


def _clue(text: str) -> bool:
    """Whether there is anything that a transducer might rewrite."""
    return any(pattern.search(text) for pattern in _CLUES)


class Tape:
    """A rewritten text in which every character knows the stretch of the source it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int64)
        self.end = self.start + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the given stretches (sorted, disjoint) of the present text."""
        pieces, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            pieces += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        if edits:
            self.text = "".join([*pieces, self.text[at:]])
            self.start = np.concatenate([*starts, self.start[at:]])
            self.end = np.concatenate([*ends, self.end[at:]])

    def source(self, a: int, b: int) -> tuple[int, int]:
        """The stretch of the source behind ``text[a:b]``."""
        return int(self.start[a]), int(self.end[b - 1])


def _plain(char: str) -> str:
    """The ASCII form of one character, itself if there is none of the same length or longer."""
    folded = unicodedata.normalize("NFKC", char).translate(_LOOK)
    return folded if folded.isascii() and folded else char


def homoglyphs(tape: Tape) -> None:
    edits = []
    for m in _ODD.finditer(tape.text):
        char = m[0]
        new = "" if unicodedata.category(char) == "Cf" else _plain(char)
        if new != char and (new or m.start()):
            edits.append((m.start(), m.end(), new))
    tape.rewrite(edits)


def _value(word: str) -> str:
    return _SPELLED[word.translate(_CASES).lower()]


def spelled_digits(tape: Tape) -> None:
    edits = []
    for run in _RUN.finditer(tape.text):
        words = list(_ONE.finditer(tape.text, run.start(), run.end()))
        for word, after in zip(words, [*words[1:], None], strict=True):
            end = word.end()
            if after is not None and tape.text[end : after.start()].strip() == "":
                end = after.start()
            edits.append((word.start(), end, _value(word[0])))
    tape.rewrite(edits)
    tape.rewrite([(m.start(), m.end(), _value(m[0])) for m in _BY_DOT.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _LETTER_DIGIT.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])


def _name_start(text: str, end: int, least: int) -> int | None:
    """Where a name with bare dots that ends at ``end`` begins, as far left as it may, not before ``least``."""
    start, at = None, end
    while True:
        first = at
        while first > least and _NAME_CHAR.match(text, first - 1):
            first -= 1
        if first == at:
            return start
        if first == 0 or not _BEFORE_NAME.match(text, first - 1):
            start = first
        dot = None if "." in text[first:at] else _DOT_BEFORE.search(text[max(least, first - 7) : first])
        if dot is None:
            return start
        at = first - (dot.end() - dot.start())


def bare_addresses(text: str) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """Start, end and the stretch of the sign of each address in bare words, from the left.

    Each sign is looked at once, with the words that lead to it and from it, so a long
    chain of words does not start over at each of them.
    """
    least = at = 0
    while sign := _AT.search(text, at):
        at = sign.start() + 1
        host = _HOST.match(text, sign.end())
        start = _name_start(text, sign.start(), least) if host else None
        if start is not None:
            yield start, host.end(), sign.span()
            least = at = host.end()


def signs(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), "@" if m["at"] else ".") for m in _SIGN.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), ".") for m in _DIGIT_DOT.finditer(tape.text)])
    edits = []
    for start, end, sign in bare_addresses(tape.text):
        dots = list(_DOT.finditer(tape.text, start, end))
        if dots:
            edits += sorted([(*sign, "@"), *((d.start(), d.end(), ".") for d in dots)])
    tape.rewrite(edits)
    edits = []
    for m in _SPACED.finditer(tape.text):
        edits += sorted([(*m.span("at"), "@"), *((d.start(), d.end(), ".") for d in _SPACED_DOT.finditer(tape.text, m.start(), m.end()))])
    tape.rewrite(edits)


def disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows, in source positions, none within a plain span of its kind."""
    if not _clue(text):
        return []
    tape = Tape(text)
    for step in (homoglyphs, spelled_digits, signs):
        step(tape)
    if tape.text == text:
        return []
    # Spans of one kind do not overlap, so only the last one that starts in time can cover.
    plain = {kind: [(a, b) for a, b, k in base if k == kind] for kind in range(len(KINDS))}
    out = []
    for a, b, kind in detect(tape.text):
        lo, hi = tape.source(a, b)
        before = bisect_right(plain[kind], lo, key=lambda span: span[0])
        if not before or plain[kind][before - 1][1] < hi:
            out.append((lo, hi, kind))
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``, ``base_spans``.

    ``spans`` lists all spans as kind:start:end in code points of the source, by start
    then kind, and the four numbers count them; ``base_spans`` lists the plain ones,
    whose digest is ``base_sha256``. Plain spans are never changed or dropped; a
    disguised span is added unless a plain span of its kind covers it, so a plain match
    on the rest of a disguised identifier is listed, and counted, next to the whole one. NULL and empty texts have no
    spans; repeated rows give equal answers; an empty table works; other columns are
    ignored.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            numbers, digest, listed, plain = [], [], [], []
            for value in texts(batch):
                base = detect(value)
                every = base + disguised(value, base)
                numbers.append([sum(k == kind for _, _, k in every) for kind in range(len(KINDS))])
                plain.append(spans_text(base))
                digest.append(hashlib.sha256(plain[-1].encode()).hexdigest())
                listed.append(spans_text(every))
            counts = np.array(numbers, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(counts[:, i]) for i in range(len(KINDS))), pa.array(digest, pa.string()),
                 pa.array(listed, pa.string()), pa.array(plain, pa.string())],
                ["key", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "base_spans"])

    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    spec = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(run, f"key bigint, {spec}, base_sha256 string, spans string, base_spans string").withColumnRenamed("key", key)


by_value(__name__)
