"""Best-fit packing by length patterns.

1. Tokens.  Every text becomes ids plus an end mark; only longer ones are cut, into pieces of `size` tokens.
2. Histogram.  Pieces are counted by length: at most `size` rows, whatever the corpus.
3. Patterns.  Multisets of few lengths with a sum of `size` or little less are enumerated (at most MAX_PATTERNS), and
   how often each is to be used is fitted to the histogram by non-negative least squares.  Rounding down leaves
   residual counts, which a best fit on the histogram packs: take the longest length left, fill the gap with the
   longest that fits, repeat this pattern as often as the counts allow.  Each step uses up a length.
4. Assignment.  A pattern used x times owns x consecutive sequences, and each of its slots owns x consecutive ranks
   among the pieces of its length.  The task that makes a piece numbers it among its own pieces of that length; with the
   counts of (length, task) added up in order that gives the rank, so pieces of one length are never gathered, however
   many there are.  Sequence and offset follow by binary search in the pattern table.

What reaches the driver is the histogram and what is broadcast is the pattern table: both bounded by `size` and
MAX_PATTERNS, not by the input.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.llm.common import cut, parts, table

#: Patterns that take part in the fit.
MAX_PATTERNS = 20_000
#: Words whose ids a worker keeps, at most twice as many, and the longest of them.
MAX_WORDS, LONGEST = 250_000, 40

#: Characters that Python's split() takes for white space and the tokenizer doesn't.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: What the vocabulary takes for a word of its own, after lower-casing.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_BLOCK = 1 << 20
#: Up to here letters have one lower-case letter each, but for those whose lower case is longer; none composes with
#: what follows, and no context changes its case.
LATIN_END = "\u0250"
_BEYOND = re.compile(f"[{LATIN_END}-\U0010ffff]")
#: A word of the vocabulary's ends where one of these follows a letter or number, so it can be cut there: by something
#: that split() takes for white space and that no text has where it is used.
_MARKS, _CUT = ".,;:!?", _ODD_SPACE[-1]
_LATIN_WORD = "A-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾"
_JOINED_MARK = re.compile(rf"{_CUT}(?<=[^\s{_LATIN_WORD}]{_CUT})")
# How the vocabulary shows bytes: printable ones as themselves, the rest as U+0100 and up, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SHOWN = {b: 0x100 + n for n, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
#: Lower-case letters that need no look at all, and how the vocabulary shows those beyond ASCII.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_LATIN = {c: chr(c).encode().decode("latin-1").translate(_SHOWN) for c in range(0xDF, 0x100)}


class _Kept(dict):
    """Ids of words.  One that isn't kept is looked up among the old ones or made when it is asked for, so that a word
    takes one look."""

    def __init__(self, old: dict[str, bytes], make: Callable[[str], bytes]):
        super().__init__()
        self.old, self.make = old, make

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word) or self.make(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.  White space never joins two words in this vocabulary, so each
    blank-separated word is encoded once and kept.  Words of Latin characters are the ids of the vocabulary's own words in
    them, one after the other; what those are in other words is left to the tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.merges = self.tok.model.tokenize
        self.raw = [i.to_bytes(4, "little") for i in range(max(self.tok.get_vocab().values()) + 1)]
        #: Marks of their own, like that of a text's end, are told by case, before anything is lowered.
        self.added = [x.content for x in self.tok.get_added_tokens_decoder().values()]
        self.words = _Kept({}, self._made)

    def _ids(self, text: str) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids])

    def _merged(self, shown: str) -> bytes:
        """The ids of one of the vocabulary's own words: merges are all there is to do."""
        raw = self.raw
        return b"".join([raw[t.id] for t in self.merges(shown)])

    def _made(self, word: str) -> bytes:
        if _LETTERS.fullmatch(word):
            return self._merged(word if word.isascii() else word.translate(_LATIN))
        # What is a letter there depends on the version of Unicode.
        if max(word) >= LATIN_END or any(x in word for x in self.added):
            return self._ids(word)
        own = _WORD.findall(word.lower())
        if own == [word]:
            return self._merged(word.encode().decode("latin-1").translate(_SHOWN))
        return b"".join([self.words[x] for x in own])

    def _split(self, text: str) -> list[str]:
        """The words of a text or a block of it, in lower case where that is what the vocabulary's own steps make of it,
        whatever their version of Unicode."""
        if not text.isascii() and _BEYOND.search(text):
            return text.split()
        low = text.lower()
        if any(x in low for x in self.added):
            return text.split()
        for mark in _MARKS:
            low = low.replace(mark, _CUT + mark)
        return _JOINED_MARK.sub("", low).split()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        for t in texts:
            if any(x in t for x in _ODD_SPACE):
                yield b"".join(self._ids(x) for x in blocks(t))
            else:
                yield self._joined(t) if len(t) <= _BLOCK else b"".join(self._joined(x) for x in blocks(t))

    def _joined(self, text: str) -> bytes:
        """The ids of a text or a block of it.  When MAX_WORDS are kept they become the old ones, of which only those that
        are met again are kept on."""
        ids = b"".join(map(self.words.__getitem__, self._split(text)))
        if len(self.words) > MAX_WORDS:
            self.words.old, self.words = {}, _Kept(self.words, self._made)
        return ids


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """The worker's encoder; its words are kept from task to task."""
    return Encoder(path)


def blocks(text: str) -> Iterator[str]:
    """text in parts of about _BLOCK characters, cut at blanks only."""
    at = 0
    while len(text) - at > _BLOCK:
        end = max(text.rfind(" ", at, at + _BLOCK), text.rfind("\n", at, at + _BLOCK))
        if end <= at:
            found = [x for x in (text.find(" ", at + _BLOCK), text.find("\n", at + _BLOCK)) if x >= 0]
            end = min(found, default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def tokenized(docs: DataFrame, path: str, size: int, key: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids_crc32, and its number among the pieces of that length that
    the same task made."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(path)
        mark = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()  # the same when the task is run again
        made = [0] * (size + 1)
        for b in parts(batches, text):
            rows = []
            for k, ids in zip(b[key], encoder.encode([t if isinstance(t, str) else "" for t in b[text]]), strict=True):
                ids += mark
                for i, at in enumerate(range(0, len(ids) // 4, size)):
                    part = ids[4 * at : 4 * (at + size)]
                    n = len(part) // 4
                    rows.append((k, i, at, n, zlib.crc32(part), task, made[n]))
                    made[n] += 1
            yield pd.DataFrame(rows, columns=[key, "piece", "start", "length", "ids_crc32", "_task", "_nth"]).astype({key: b[key].dtype})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, _task int, _nth long")


def patterns(counts: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Multisets of two to four lengths present that fill a sequence exactly, or as well as any partner allows."""
    have = np.flatnonzero(counts)
    have = have[(have > 0) & (have < size)]
    if not len(have):
        return []
    below = np.full(size + 1, -1, np.int64)  # the longest length present that is at most so long
    below[have] = have
    below = np.maximum.accumulate(below)
    out = {(int(a), int(below[size - a])) for a in have[::-1] if below[size - a] > 0}
    step = max(1, len(have) * len(have) // (2 * MAX_PATTERNS))
    for j, a in enumerate(have[::-1]):
        for b in have[have <= min(a, size - a)][:: step * 2 + (j % 2)][: MAX_PATTERNS // len(have) + 1]:
            c = below[size - a - b] if size - a - b > 0 else -1
            if c > 0:
                out.add(tuple(sorted((int(a), int(b), int(c)), reverse=True)))
                rest = size - a - b - c
                if rest > 0 and below[rest] > 0:
                    out.add(tuple(sorted((int(a), int(b), int(c), int(below[rest])), reverse=True)))
    ranked = sorted({tuple(sorted(p, reverse=True)) for p in out}, key=lambda p: (size - sum(p), len(p), p))
    return ranked[:MAX_PATTERNS]


def fit(found: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares of pattern counts against the histogram: accelerated projected gradient."""
    at = np.array([l for p in found for l in p], np.int64)
    of = np.repeat(np.arange(len(found)), [len(p) for p in found])
    target = counts.astype(float)
    # An upper bound of the largest eigenvalue of AtA: largest row sum times largest column sum of A.
    bound = float(np.bincount(at, minlength=len(counts)).max() * max(len(p) for p in found))
    x = np.zeros(len(found))
    y, t = x, 1.0
    for _ in range(rounds):
        gap = np.bincount(at, y[of], len(counts)) - target
        new = np.maximum(y - np.bincount(of, gap[at], len(found)) / bound, 0)
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / nt * (new - x), new, nt
    return x


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, times) that use up counts (index: length) exactly."""
    left = counts.astype(np.int64).copy()
    out = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    if found := patterns(left, size):
        times = np.floor(fit(found, left) + 1e-9).astype(np.int64)
        for k in sorted(range(len(found)), key=lambda k: (size - sum(found[k]), -times[k])):
            lengths, need = np.unique(found[k], return_counts=True)
            n = int(min(times[k], (left[lengths] // need).min()))
            if n > 0:
                left[lengths] -= n * need
                out.append((found[k], n))
    while left.any():
        gap, pattern, spare = size, [], left.copy()
        while gap > 0 and (have := np.flatnonzero(spare[: gap + 1])).size:
            pattern.append(int(have[-1]))
            spare[have[-1]] -= 1
            gap -= have[-1]
        lengths, need = np.unique(pattern, return_counts=True)
        n = int((left[lengths] // need).min())
        left[lengths] -= n * need
        out.append((tuple(pattern), n))
    return out


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank of each slot, its first sequence, its offset."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for pattern, times in chosen:
        offset = 0
        for l in pattern:
            rows.setdefault(l, []).append((used.get(l, 0), first, offset))
            used[l] = used.get(l, 0) + times
            offset += l
        first += times
    return {l: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for l, r in rows.items()}


def packed(found: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """Pieces (rows of tokenized(), stored) with sequence_id and offset."""
    spark = found.sparkSession
    counts = cut(found.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n")), "counts")
    histogram = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most `size` rows
        histogram[r["length"]] = r["n"]
    shared = spark.sparkContext.broadcast(slots(plan(histogram, size)))

    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "_task", F.coalesce(before, F.lit(0)).alias("_before"))
    # The counts grow with the tasks, so they are dealt with the pieces; a length of one task has few of either.
    ranked = found.join(starts.hint("merge"), ["length", "_task"]).withColumn("_rank", F.col("_before") + F.col("_nth"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        for b in batches:
            seq, off = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            rank = b["_rank"].to_numpy()
            for l, idx in b.groupby("length").indices.items():
                first, sequence, offset = at[int(l)]
                k = np.searchsorted(first, rank[idx], "right") - 1
                seq[idx], off[idx] = sequence[k] + rank[idx] - first[k], offset[k]
            yield b.drop(columns="_rank").assign(sequence_id=seq, offset=off)

    out = ranked.select(key, "piece", "start", "length", "ids_crc32", "_rank")
    schema = out.drop("_rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return out.mapInPandas(place, schema)


def pack(docs: DataFrame, path: str, size: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of docs: key, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds only the end mark.  Repeated rows are packed each; a null key stays
    null.  Extra columns play no part.  An empty table gives no rows.
    """
    return packed(cut(tokenized(docs, path, size, key, text), "pieces"), size, key)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), 2048)


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLE: dict[str, str] = {}
