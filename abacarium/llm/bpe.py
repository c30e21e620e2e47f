"""Byte-pair encoding and decoding with a lexicon automaton.

The frequent words of all documents are counted first, encoded once, and compiled
into a shared automaton with id outputs. Executors map it into memory; words that
it does not hold are merged exactly, rank by rank. The vocabulary is a JSON file of
a word-end BPE (lower-cased, white space dropped), whose place is a parameter.

Texts whose characters all lie below U+0530, also when composed and lower-cased, are normalised and split by the rules
written here. For others the tokenizer's own normaliser and splitter are asked,
because their Unicode tables may be newer than Python's; merging is the same.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from abacarium.llm.automaton import Automaton, compile_words
from abacarium.llm.common import by_value, most_frequent, small_batches, texts

#: Texts below this character are normalised and split here.
_LIMIT = 0x530


def _splitter() -> re.Pattern:
    """The word rule: contractions, letters, single digits, runs of anything else but white space."""

    def listed(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(_LIMIT) if regex.match(kind, chr(c)))

    letter, number, space = listed(r"\p{L}"), listed(r"\p{N}"), listed(r"\s")
    # Letters first: only the last two begin alike.
    return re.compile(f"[{letter}]+|[{number}]|'(?:[stmd]|re|ve|ll)|[^{space}{letter}{number}]+")


_SPLIT = _splitter()
_LATER = re.compile("[԰-\U0010ffff]")
#: White space for ``str.split`` that is none for the word rule.
_NO_SPACE = re.compile("[\x1c-\x1f]")
_NEVER = 1 << 62
_NONE = np.iinfo(np.int32).max
#: Widths of the tables in which words are merged together; fewer than ``_FEW`` words, or longer ones, go one by one.
_WIDTHS, _FEW = (4, 8, 12, 16, 24, 32, 64), 64
#: Counted words and runs that a task holds. Two of an executor's workers hold these, and what ``_KEEP`` allows, at once.
_FLUSH, _FOLD = 150_000, 60_000
#: Words outside the lexicon that are remembered, at about 0.6 KB each; they are rare, so that more would seldom be met again.
_KEEP = 80_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(rest)) for b in range(256)]


class Splitter:
    """Splits texts into special tokens and normalised words; counting needs no more than this."""

    def __init__(self, vocabulary: str):
        self._begin(vocabulary, json.loads(vocabulary))

    def _begin(self, vocabulary: str, spec: dict) -> None:
        self.source = vocabulary
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.library = None

    def plain(self, text: str) -> str | None:
        """The text, composed and lower-cased, None if that is up to the library."""
        if text.isascii():
            return text.lower()
        # Composed and lower-cased first: both may lead to characters beyond the limit.
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return None if _LATER.search(text) or _LATER.search(low) else low

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        low = self.plain(text)
        return self._split_by_library(text) if low is None else _SPLIT.findall(low)

    def _split_by_library(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.source)
            self.back = {c: b for b, c in enumerate(byte_letters())}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.back[c] for c in piece).decode("utf-8") for piece, _ in pieces]


class Encoder(Splitter):
    """Encodes and decodes texts; ``lexicon`` is a compiled automaton or None."""

    def __init__(self, vocabulary: str, lexicon: bytes | None = None):
        spec = json.loads(vocabulary)
        self._begin(vocabulary, spec)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.outer = [vocab[c + end] for c in letters]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = rank << 20 | vocab[a + b]
        # Sorted pairs with their ranks, and the id that each rank makes, for many words at once.
        pairs = np.array([a << 20 | b for a, b in self.merges] + [_NEVER], np.int64)
        found = np.array([v >> 20 for v in self.merges.values()] + [_NONE], np.int32)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], found[order]
        self.made = np.zeros(len(model["merges"]), np.int32)
        self.made[found[:-1]] = [v & 0xFFFFF for v in self.merges.values()]
        self.numbers = {i: str(i) for i in [*vocab.values(), *self.special.values()]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.lexicon = Automaton(lexicon) if lexicon else None
        # Entries in columns, a number for each: single objects per word would be work for Python's garbage collector.
        self.sizes: list[int] = []
        self.as_numbers: list[str] = []
        self.as_tokens: list[str] = []
        self.as_bytes: list[bytes] = []
        self.known: dict[str, int] = {}
        # The numbers of special tokens and of words in the lexicon, which stay.
        self.kept = self._remember(list(self.special), [[i] for i in self.special.values()])

    def merge(self, word: bytes) -> list[int]:
        """Merge the bytes of one word, always the pair of lowest rank first."""
        ids = [self.inner[b] for b in word]
        ids[-1] = self.outer[word[-1]]
        if len(ids) > 64:
            return self._merge_long(ids)
        get = self.merges.get
        ranks = [get(p, _NEVER) for p in zip(ids, ids[1:])]  # noqa: B905
        while ranks and (low := min(ranks)) != _NEVER:
            at = ranks.index(low)
            ids[at] = low & 0xFFFFF
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), _NEVER)
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and a linked list, for words of any length."""
        n, get = len(ids), self.merges.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = rank & 0xFFFFF, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := get((ids[i], ids[after[j]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [i for i in ids if i >= 0]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.ranks[at], np.int32(_NONE))

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of every word; words of like length take each step together."""
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words) + bytes(_WIDTHS[-1]), np.uint8)
        inner, outer = np.array(self.inner, np.int32), np.array(self.outer, np.int32)
        least = 0
        for width in _WIDTHS:
            rows = np.flatnonzero((sizes > least) & (sizes <= width))
            least = width
            if len(rows) < _FEW:
                continue
            place, size = np.arange(width + 1), sizes[rows, None]
            units = data[starts[rows, None] + np.minimum(place, width - 1)]
            # After the last token of a word stands -1, which no pair has.
            ids = np.where(place < size - 1, inner[units], np.where(place < size, outer[units], np.int32(-1)))
            rank = np.full(ids.shape, _NONE, np.int32)
            rank[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
            while len(rows):
                low = rank.min(axis=1)
                done = low == _NONE
                if done.any():
                    ended = ids[done]
                    ends = np.cumsum((ended >= 0).sum(axis=1)).tolist()
                    flat, lo = ended[ended >= 0].tolist(), 0
                    for row, hi in zip(rows[done].tolist(), ends, strict=True):
                        out[row] = flat[lo:hi]
                        lo = hi
                    rows, ids, rank, low = rows[~done], ids[~done], rank[~done], low[~done]
                    if not len(rows):
                        break
                each, at = np.arange(len(rows)), rank.argmin(axis=1)
                after = place[:-1] > at[:, None]
                ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
                rank[:, :-1] = np.where(after, rank[:, 1:], rank[:, :-1])
                ids[each, at] = self.made[low]
                rank[each, at] = self._rank(ids[each, at], ids[each, at + 1])
                back = each[at > 0]
                at = at[back]
                rank[back, at - 1] = self._rank(ids[back, at - 1], ids[back, at])
        return [self.merge(word) if ids is None else ids for word, ids in zip(words, out, strict=True)]

    def _remember(self, words: list[str], found: list[list[int]]) -> dict[str, int]:
        """Entries of words, and their numbers."""
        number, token = self.numbers.__getitem__, self.tokens.__getitem__
        own = dict(zip(words, range(len(self.sizes), len(self.sizes) + len(words)), strict=True))
        self.sizes += map(len, found)
        self.as_numbers += [" ".join(map(number, ids)) for ids in found]
        self.as_tokens += [" ".join(map(token, ids)) for ids in found]
        self.as_bytes += [array("i", ids).tobytes() for ids in found]
        self.known.update(own)
        return own

    def _forget(self) -> None:
        """Drop the entries of words outside the lexicon."""
        at = list(self.kept.values())
        for column in (self.sizes, self.as_numbers, self.as_tokens, self.as_bytes):
            column[:] = [column[i] for i in at]
        self.kept = dict(zip(self.kept, range(len(at)), strict=True))
        self.known = dict(self.kept)

    def _learn(self, words: list[str]) -> None:
        """Remember the entries of words: from the lexicon if it holds them, else by merging."""
        raw = [w.encode() for w in words]
        numbers = self.lexicon.numbers(raw) if self.lexicon else np.full(len(raw), -1)
        held, others = np.flatnonzero(numbers >= 0), np.flatnonzero(numbers < 0).tolist()
        if len(held):
            self.kept.update(self._remember([words[i] for i in held.tolist()], self.lexicon.outputs(numbers[held])))
        if others:
            self._remember([words[i] for i in others], self.merge_all([raw[i] for i in others]))

    def entries(self, values: list[str]) -> list[list[int]]:
        """Per text, the numbers of the entries of its words and special tokens; they hold until the next call."""
        split = []
        for text in values:
            parts = self.cut.split(text) if self.cut else [text]
            split.append(self.words(text) if len(parts) == 1 else [
                w for p in parts for w in ([p] if p in self.special else self.words(p))])
        flat = list(chain.from_iterable(split))
        found = list(map(self.known.get, flat))
        new = {w for w, number in zip(flat, found, strict=True) if number is None}
        if len(self.known) - len(self.kept) + len(new) > _KEEP:
            self._forget()
            found = list(map(self.known.get, flat))
            new = {w for w, number in zip(flat, found, strict=True) if number is None}
        if new:
            self._learn(list(new))
            found = [self.known[w] if number is None else number for w, number in zip(flat, found, strict=True)]
        ends = list(accumulate(map(len, split)))
        return [found[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]

    def joined(self, column: list, entries: list[int], blank=" "):
        """A column of the given entries, joined."""
        return blank.join(map(column.__getitem__, entries))

    def ids(self, entries: list[int]) -> np.ndarray:
        return np.frombuffer(self.joined(self.as_bytes, entries, b""), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.ids(self.entries([text])[0]).tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks, special ones too; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def encoder_of(shared: Broadcast) -> Encoder:
    """The encoder of this process; a broadcast value lives as long as its worker."""
    state = shared.value
    if "encoder" not in state:
        state["encoder"] = Encoder(state["vocabulary"], state["lexicon"])
    return state["encoder"]


def splitter_of(shared: Broadcast) -> Splitter:
    """The splitter of this process."""
    state = shared.value
    if "splitter" not in state:
        state["splitter"] = Splitter(state["vocabulary"])
    return state["splitter"]


def word_counts(docs: DataFrame, vocabulary: Broadcast, text: str = "text") -> DataFrame:
    """``word``, ``n`` over all documents; each task counts its own words before the shuffle."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen, runs = splitter_of(vocabulary), Counter(), Counter()
        for batch in source:
            for value in texts(batch):
                for part in splitter.cut.split(value) if splitter.cut else [value]:
                    if part in splitter.special:
                        continue
                    low = splitter.plain(part)
                    if low is None:
                        seen.update(splitter.words(part))
                    else:
                        # No word reaches over white space: what lies between is counted first, each split once.
                        runs.update(_SPLIT.findall(low) if _NO_SPACE.search(low) else low.split())
                if len(runs) > _FOLD:
                    _fold(runs, seen)
                if len(seen) > _FLUSH:
                    yield from _counted(seen)
                    seen.clear()
        _fold(runs, seen)
        yield from _counted(seen)

    return small_batches(docs).select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word string, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n"))


def _fold(runs: Counter, seen: Counter) -> None:
    """Add the words of counted runs to ``seen``, and empty ``runs``."""
    for run, n in runs.items():
        for word in _SPLIT.findall(run):
            seen[word] += n
    runs.clear()


def _counted(seen: Counter) -> Iterator[pa.RecordBatch]:
    words, counts = list(seen.keys()), list(seen.values())
    for lo in range(0, len(words), 20_000):
        yield pa.RecordBatch.from_pydict({"word": pa.array(words[lo : lo + 20_000], pa.string()), "n": pa.array(counts[lo : lo + 20_000], pa.int64())})


def frequent_words(counts: DataFrame, size: int = 100_000, least: int = 8) -> list[str]:
    """At most ``size`` words, the most frequent ones, each seen ``least`` times or more."""
    return most_frequent(counts, size, least).select("word").toArrow()["word"].to_pylist()


def build_encoder(docs: DataFrame, path: str, size: int = 100_000, text: str = "text") -> Broadcast:
    """The shared encoder: the vocabulary at ``path`` and the lexicon of the frequent words of ``docs``.

    What is broadcast is bounded by the vocabulary file and by ``size`` words.
    """
    context = docs.sparkSession.sparkContext
    vocabulary = Path(path).read_text(encoding="utf-8")
    plain = context.broadcast({"vocabulary": vocabulary, "lexicon": None})
    listed = sorted(w.encode() for w in frequent_words(word_counts(docs, plain, text), size) if len(w) <= 64)
    lexicon = compile_words(zip(listed, Encoder(vocabulary).merge_all(listed), strict=True)) if listed else None
    return context.broadcast({"vocabulary": vocabulary, "lexicon": lexicon})


def _per_text(docs: DataFrame, encoder: Broadcast, key: str, text: str, make, kinds: pa.Schema, spec: str) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), *kinds])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                own = encoder_of(encoder)
                cols = list(zip(*[make(own, found) for found in own.entries(list(texts(part)))], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), *(c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, kinds, strict=True))], schema=schema)

    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key bigint, {spec}").withColumnRenamed("key", key)


def encode(docs: DataFrame, encoder: Broadcast, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ``n_tokens``, ``ids`` per row. NULL and empty texts have no ids; repeated rows are encoded each."""

    def make(own: Encoder, entries: list[int]) -> tuple:
        ids = own.ids(entries)
        return len(ids), ids

    kinds = pa.schema([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _per_text(docs, encoder, key, text, make, kinds, "n_tokens bigint, ids array<int>")


def token_lengths(docs: DataFrame, encoder: Broadcast, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ``n_tokens`` per row."""
    return _per_text(docs, encoder, key, text, lambda own, entries: (sum(map(own.sizes.__getitem__, entries)),), pa.schema([("n_tokens", pa.int64())]), "n_tokens bigint")


def decode(rows: DataFrame, encoder: Broadcast, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, ``text`` per row of ids; NULL ids give the empty text."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            back = encoder_of(encoder).decode
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([back(v.as_py() or []) for v in batch.column("ids")], pa.string())], ["key", "text"])

    return rows.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids")).mapInArrow(
        run, "key bigint, text string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, encoder: Broadcast, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode, then decode: key, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` per row, and ``ids`` if asked for.

    NULL and empty texts give no ids and the digests of the empty text. Repeated
    rows give a row each; an empty table gives no rows; other columns are ignored.
    """

    def make(own: Encoder, entries: list[int]) -> tuple:
        sha = lambda column: hashlib.sha256(own.joined(column, entries).encode()).hexdigest()
        found = sum(map(own.sizes.__getitem__, entries)), sha(own.as_numbers), sha(own.as_tokens)
        return (*found, own.ids(entries)) if with_ids else found

    kinds = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    spec = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        kinds, spec = [*kinds, ("ids", pa.list_(pa.int32()))], spec + ", ids array<int>"
    return _per_text(docs, encoder, key, text, make, pa.schema(kinds), spec)


by_value(__name__)
