"""Benchmark decontamination by latent semantic retrieval.

1. Texts are read once and kept as word numbers in the vocabulary of the benchmark items (other words: -1).
2. Document frequencies of these words are counted over all documents; words in more than COMMON of them (and
   over 50) weigh 0, but each item keeps its RAREST rarest.
3. Documents are cut into passages of PASSAGE words.  A randomised SVD of their TF-IDF matrix A gives a latent space of
   RANK dimensions: Y = At (A R) for a random R, Q = orth(Y), then Z = At (A Q) and the eigenvectors of Qt Z.  Each
   product is one pass in which a task sums its own words-by-RANK matrix; the sums are added up in a tree, ROWS words at
   a time, and what reaches the driver has as many rows as the items have words.
4. Windows of WINDOW words that overlap by half are compared with the items (in pieces of WINDOW words) by cosine in
   that space; pairs over COSINE are candidates.  A window whose words weigh less than MASS of a piece can't hold
   enough of it to be confirmed and isn't compared.
5. A candidate is confirmed if the longest common subsequence of the item and the words around the window is LCS of the
   item's length at least, and likewise for the item's answer, its last sentence (ANSWER at least, of LEAST_ANSWER words
   or more).  Swapped, dropped or added words lower these only a little, so paraphrases are found with the verbatim
   copies.  How many words both have in common, in any order, is an upper bound and is looked at first.  A run of
   VERBATIM words that both share word for word is a leak whatever the answer.

Items are collected in groups of GROUP, whose words the texts are encoded by, and searched in blocks of ITEMS, each with
its own space; so memory doesn't depend on their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, give_back, parts, table

GROUP, ITEMS, PASSAGE, WINDOW, RANK, COMMON, COSINE, MASS, LCS, ANSWER = 50_000, 5000, 64, 32, 128, 0.05, 0.25, 0.5, 0.6, 0.5
WORD, SENTENCE = re.compile(r"[^\W_]+"), re.compile(r"[^.!?\n]+")
#: What no word holds beyond ASCII; and a table that makes blanks of what no word holds within it.
MARK, BLANKS = re.compile(r"[^\w\x00-\x7f]"), bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
HALF, ROWS, LEAST_ANSWER, RAREST, VERBATIM = WINDOW // 2, 32, 6, 8, 25


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_bytes(text: str) -> list[bytes]:
    """words() in UTF-8; texts without marks beyond ASCII are split as bytes."""
    text = text.lower()
    if text.isascii() or not MARK.search(text):
        return text.encode("utf-8", "replace").translate(BLANKS).split()
    return [w.encode("utf-8", "replace") for w in WORD.findall(text)]


@dataclass(frozen=True)
class Words:
    """How the stored numbers of a group's words are read by one block of items: number is -1 for words of other blocks,
    and its last place stands for the words of none."""

    kind: type
    number: np.ndarray
    size: int

    def __call__(self, raw: bytes) -> np.ndarray:
        return self.number[np.frombuffer(raw, self.kind)]


def kind_of(n_words: int) -> type:
    return np.int16 if n_words < 1 << 15 else np.int32


def all_words(n: int) -> Words:
    """Every word of a group of n by its own number."""
    return Words(kind_of(n), np.append(np.arange(n), -1), n)


def encoded(docs: DataFrame, vocabulary: dict[str, int], key: str, text: str) -> DataFrame:
    """(key, words: binary of word numbers, -1 for words outside of the vocabulary)."""
    shared = docs.sparkSession.sparkContext.broadcast({w.encode("utf-8", "replace"): n for w, n in vocabulary.items()})
    kind = kind_of(len(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value.get
        for b in parts(batches, text):
            out = []
            for t in b[text]:
                ids = np.array([known(w, -1) for w in word_bytes(t)], kind) if isinstance(t, str) else np.zeros(0, kind)
                out.append(ids.tobytes())
            yield pd.DataFrame({key: b[key], "words": out})

    return docs.select(key, text).mapInPandas(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, words binary")


def frequencies(found: DataFrame, n_words: int) -> np.ndarray:
    """In how many rows each word occurs."""
    read = all_words(n_words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(n_words, np.int64)
        for b in batches:
            for raw in b["words"]:
                ids = np.unique(read(raw))
                count[ids[ids >= 0]] += 1
        b = None
        give_back()
        at = np.flatnonzero(count)
        yield pd.DataFrame({"word": at, "n": count[at]})

    out = np.zeros(n_words, np.int64)
    for r in found.select("words").mapInPandas(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[r["word"]] = r["n"]
    return out


def _blocks(batch: pd.Series, read: Words, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weighted words of a batch: their ids and their block numbers (blocks of `size` words, never across rows), and
    for all blocks their row and number in it."""
    x = read(b"".join(batch))
    n = np.array([len(raw) for raw in batch], np.int64) // np.dtype(read.kind).itemsize
    end, blocks = np.cumsum(n), -(-n // size)
    first = np.cumsum(blocks) - blocks
    at = np.flatnonzero(np.append(weight > 0, False)[x])  # -1 finds the last place
    row = np.searchsorted(end, at, "right")
    of = np.repeat(np.arange(len(n)), blocks)
    return x[at], (at - (end - n)[row]) // size + first[row], of, np.arange(len(of)) - first[of]


def _summed(ids: np.ndarray, groups: np.ndarray, n: int, table_: np.ndarray) -> np.ndarray:
    """Sum of table_[ids] by group; groups ascend."""
    out = np.zeros((n, table_.shape[1]), np.float32)
    if len(ids):
        first = np.flatnonzero(np.diff(groups, prepend=-1))
        out[groups[first]] = np.add.reduceat(table_[ids], first, axis=0)
    return out


def gram_product(found: DataFrame, read: Words, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """At (A right) for the TF-IDF matrix A of the passages."""
    n_words, rank = right.shape
    shared = found.sparkSession.sparkContext.broadcast((weight, (right * weight[:, None]).astype(np.float32)))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, weighted = shared.value
        total = np.zeros((n_words, rank))
        for b in batches:
            for at in range(0, len(b), 500):
                ids, block, _, nth = _blocks(b["words"].iloc[at : at + 500], read, w, PASSAGE)
                passages = _summed(ids, block, len(nth), weighted)
                order = np.argsort(ids, kind="stable")
                total += _summed(block[order], ids[order], n_words, passages)
        b = ids = block = nth = passages = order = None
        give_back()
        task = TaskContext.get().partitionId()  # the same when the task is run again
        for k in range(0, n_words, ROWS):
            yield pd.DataFrame({"salt": [task], "k": [k], "part": [total[k : k + ROWS].astype(np.float32).tobytes()]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.float32).astype(float) for x in rows["part"]).astype(np.float32)
        return pd.DataFrame({"salt": [rows["salt"].iloc[0]], "k": [rows["k"].iloc[0]], "part": [total.tobytes()]})

    sums = found.select("words").mapInPandas(partial, "salt int, k int, part binary")
    for fan in (1024, 32, 1):  # a tree of sums, so that no task adds up very many parts
        sums = sums.withColumn("salt", F.col("salt") % fan).groupBy("salt", "k").applyInPandas(add, "salt int, k int, part binary")
    out = np.zeros((n_words, rank))
    for r in sums.collect():
        out[r["k"] : r["k"] + ROWS] = np.frombuffer(r["part"], np.float32).reshape(-1, rank)
    return out * weight[:, None]


def latent_space(found: DataFrame, read: Words, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (words by rank) of the passages' TF-IDF matrix."""
    rank = min(rank, len(weight))
    random = np.random.default_rng(11).standard_normal((len(weight), rank))
    q, _ = np.linalg.qr(gram_product(found, read, weight, random))
    inner = q.T @ gram_product(found, read, weight, q)
    _, turn = np.linalg.eigh((inner + inner.T) / 2)
    return q @ turn[:, ::-1]


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        m = where.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _windows(ids: np.ndarray, block: np.ndarray, chosen: np.ndarray, both: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """Sums of table_ over the words of the chosen half windows, and of the half after it where both is set."""
    out = []
    for half, used in ((chosen, slice(None)), (chosen[both] + 1, both)):
        a, b = np.searchsorted(block, half), np.searchsorted(block, half, "right")
        at = np.repeat(a - np.append(0, np.cumsum(b - a)[:-1]), b - a) + np.arange((b - a).sum())
        sums = np.zeros((len(chosen), table_.shape[1]), np.float32)
        sums[used] = _summed(ids[at], np.repeat(np.arange(len(half)), b - a), len(half), table_)
        out.append(sums)
    return out[0] + out[1]


def _share_run(need: np.ndarray, around: np.ndarray) -> bool:
    """Whether VERBATIM words in a row of the item also stand in a row in the text."""
    if min(len(need), len(around)) < VERBATIM:
        return False
    view = np.lib.stride_tricks.sliding_window_view
    runs = {x.tobytes() for x in view(need, VERBATIM)}
    return any(x.tobytes() in runs for x in view(around, VERBATIM))


#: Cosines that are made at once, of some windows with all pieces of a block of items.
CELLS = 1 << 22


def _search(found: DataFrame, key: str, kind: str, items: list[tuple], read: Words, weight: np.ndarray, space: np.ndarray) -> DataFrame:
    n_words = len(weight)
    pieces, owner = [], []
    for i, (_, ids, _) in enumerate(items):
        for at in range(0, max(1, len(ids) - HALF), HALF):
            pieces.append(ids[at : at + WINDOW])
            owner.append(i)
    weighted = (space * weight[:, None]).astype(np.float32)
    vectors = np.stack([weighted[p].sum(0) for p in pieces])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    mass = np.array([weight[p].sum() for p in pieces], np.float32)
    bags = [np.unique(ids, return_counts=True) for _, ids, _ in items]
    shared = found.sparkSession.sparkContext.broadcast((items, bags, np.array(owner), vectors, mass, weight, weighted, read))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, bags, owner, vectors, mass, w, weighted, read = shared.value
        for b in batches:
            hits: dict[tuple[int, int], tuple[float, float, float]] = {}
            for start in range(0, len(b), 500):
                some = b["words"].iloc[start : start + 500]
                ids, block, row, nth = _blocks(some, read, w, HALF)
                if not len(ids):
                    continue
                same = np.append(row[1:] == row[:-1], False)
                held = np.bincount(block, w[ids], len(nth)).astype(np.float32)
                held[same] += held[1:][same[:-1]]
                live = np.flatnonzero(held >= MASS * mass.min())
                raw = some.tolist()
                last, whole = -1, None
                step = max(1, min(4096, CELLS // len(vectors)))
                for at in range(0, len(live), step):
                    chosen = live[at : at + step]
                    part = _windows(ids, block, chosen, same[chosen], weighted)
                    cosine = (part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)) @ vectors.T
                    p, j = np.nonzero((cosine >= COSINE) & (held[chosen, None] >= MASS * mass))
                    # An item is looked at once a window, whichever of its pieces are alike.
                    pairs, first = np.unique(p * len(items) + owner[j], return_index=True)
                    for w_, i, like in zip(pairs // len(items), pairs % len(items), cosine[p[first], j[first]].tolist(), strict=True):
                        r, k = row[chosen[w_]], nth[chosen[w_]] * HALF
                        if r != last:
                            last, whole = r, read(raw[r])
                        _, need, answer = items[i]
                        x = whole[max(0, k - len(need)) : k + WINDOW + len(need)]
                        own = x[x >= 0]
                        words_, n = bags[i]
                        most = np.minimum(np.bincount(own, minlength=n_words)[words_], n).sum()
                        if most < min(LCS * len(need), VERBATIM):
                            continue
                        around = own.tolist()
                        share = lcs(need, around) / len(need)
                        kept = lcs(answer, around) / len(answer)
                        if share >= LCS and kept >= ANSWER or _share_run(np.array(need, x.dtype), x):
                            old = hits.get((start + r, i))
                            if old is None or (share, kept) > old[:2]:
                                hits[start + r, i] = (share, kept, like)
            at = sorted(hits)
            ids = pd.Series([items[i][0] for _, i in at], dtype=object)
            yield pd.DataFrame({key: b[key].iloc[[r for r, _ in at]].reset_index(drop=True), "item_id": ids, "lcs": [hits[k][0] for k in at], "answer_lcs": [hits[k][1] for k in at], "cosine": [hits[k][2] for k in at]})

    return found.mapInPandas(run, f"`{key}` {found.schema[key].dataType.simpleString()}, item_id {kind}, lcs double, answer_lcs double, cosine double")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, lcs, answer_lcs, cosine) for each document that holds an item, verbatim or paraphrased.

    Null and empty texts hold nothing; items without words are held by nothing.  Repeated rows of docs are each
    reported, repeated items once; null item ids take no part.  Ids keep their types.  Documents without a hit have no
    row.  Extra columns play no part.
    """
    spark = docs.sparkSession
    kind = benchmark.schema[item].dataType.simpleString()
    given = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null").distinct()
    n_groups = max(1, -(-given.count() // GROUP))
    total = None
    out = None
    for k in range(n_groups):
        rows = sorted((r["item"], r["text"]) for r in given.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_groups)) == k).collect())
        listed = [(i, t, words(t)) for i, t in rows if words(t)]
        if not listed:
            continue
        vocabulary = {w: n for n, w in enumerate(sorted({w for _, _, x in listed for w in x}))}
        found = cut(encoded(docs, vocabulary, key, text), "encoded")
        total = found.count() if total is None else total
        df = frequencies(found, len(vocabulary))
        for at in range(0, len(listed), ITEMS):
            met = _block_leaks(found, key, kind, listed[at : at + ITEMS], vocabulary, df, total)
            out = met if out is None else out.union(met)
    if out is None:
        return spark.createDataFrame([], f"`{key}` {docs.schema[key].dataType.simpleString()}, item_id {kind}, lcs double, answer_lcs double, cosine double")
    return out


def _block_leaks(found: DataFrame, key: str, kind: str, listed: list[tuple], vocabulary: dict[str, int], df: np.ndarray, total: int) -> DataFrame:
    """leaks() of one block of items (id, text, words) in stored texts."""
    used = np.unique([vocabulary[w] for _, _, x in listed for w in x])
    number = np.full(len(vocabulary) + 1, -1, np.int64)
    number[used] = np.arange(len(used))
    read = Words(kind_of(len(vocabulary)), number, len(used))
    of = {w: int(number[vocabulary[w]]) for _, _, x in listed for w in x}
    df = df[used]
    weight = np.where(df > max(COMMON * total, 50), 0.0, np.log((total + 1) / (df + 1)) + 0.1)
    for _, _, x in listed:  # an item keeps its rarest words even if it leaked into very many documents
        rare = sorted({of[w] for w in x}, key=lambda n: (df[n], n))[:RAREST]
        weight[rare] = np.log((total + 1) / (df[rare] + 1)) + 0.1
    items = []
    for i, t, x in listed:
        last = next((s for s in reversed([words(s) for s in SENTENCE.findall(t)]) if s), x)
        last = x[-max(len(last), LEAST_ANSWER) :]
        items.append((i, [of[w] for w in x], [of[w] for w in last]))
    return _search(found, key, kind, items, read, weight, latent_space(found, read, weight))


def op4_lsa_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {"op4_lsa_decontamination": op4_lsa_decontamination}
ORACLE: dict[str, str] = {}
