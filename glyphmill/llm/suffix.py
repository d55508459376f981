"""Exact substring dedup over bytes by bucket-pointer refinement.

Every byte that lies in a WINDOW-byte string which also starts earlier goes.  Earlier means in a document with a smaller
id, or further to the front of the same document.

Sorting all suffixes isn't needed to tell which windows repeat:

1. Only suffixes at anchors (winnow.py) are bucketed, by their q-gram, together with a hash of the neighbourhood: all
   bytes of the windows that hold the anchor.  Buckets are formed by a shuffle with partial aggregates; within a
   document equal neighbourhoods are combined before.
2. All but the first of equal neighbourhoods are repeats altogether.
3. The firsts of different neighbourhoods in the same q-gram bucket may still share some windows.  Their bytes are
   fetched and refined: positions get the bucket of their first STEP bytes, and buckets of length 2 L are made by
   sorting on the pair of a position's bucket and the bucket of the position L further on, which the round before has
   just refined, until the length is WINDOW.  Equal buckets are equal windows; the first of each stays.
4. A q-gram bucket with more than CROWD members is first split by longer contexts: the half of the windows that start
   further left share the bytes before the anchor, the other half those after it.  So no task holds more than about
   CROWD neighbourhoods, however common a passage is; where a single window is left, an aggregate decides.

Found spans are gathered by document and cut out of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, discard, is_integral, mix, numbers_of, parts, table
from glyphmill.llm.winnow import Prefix, anchors

WINDOW, Q, STEP, CROWD = 100, 24, 25, 8_000
#: q-grams in a window; bytes before an anchor that can share a window with it; bytes of a whole neighbourhood.
W = WINDOW - Q + 1
LEFT = W - 1
SPAN = LEFT + WINDOW
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_LOWEST = -(1 << 63)
_RUN = 1 << 22


def _bytes(text: object) -> bytes:
    return text.encode("utf-8", "replace") if isinstance(text, str) else b""


def found(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of one text and the hashes of their q-grams and neighbourhoods."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    out = []
    # Long texts go in runs that overlap by what a neighbourhood needs on either side.
    for at in range(0, n, _RUN):
        lo, hi = max(0, at - 2 * SPAN), min(n, at + _RUN + 2 * SPAN)
        items = _VALUE[np.frombuffer(data, np.uint8, hi - lo, lo)]
        prefix = Prefix(items)
        start = np.arange(hi - lo - Q + 1)
        grams = prefix(start, start + Q)
        pos = anchors(grams, W)
        pos = pos[(pos + lo >= at) & (pos + lo < at + _RUN)]
        left, right = np.maximum(pos - LEFT, 0), np.minimum(pos + WINDOW, hi - lo)
        out.append((pos + lo, grams[pos], prefix(left, right) + mix((pos - left).astype(np.uint64))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def anchor_table(docs: DataFrame) -> DataFrame:
    """(doc, th, gram, near, pos, again) from (doc, th, text): again marks a neighbourhood that the document has before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text", 1 << 22):
            doc, th, gram, near, pos, again = [], [], [], [], [], []
            for d, h, t in zip(b["doc"], b["th"], b["text"], strict=True):
                p, g, x = found(_bytes(t))
                if not len(p):
                    continue
                _, first = np.unique(x ^ mix(g), return_index=True)
                rep = np.ones(len(p), bool)
                rep[first] = False
                doc.append(np.full(len(p), d, np.int64))
                th.append(np.full(len(p), h, np.int64))
                gram.append(g.view(np.int64))
                near.append(x.view(np.int64))
                pos.append(p)
                again.append(rep)
            if doc:
                yield pd.DataFrame({"doc": np.concatenate(doc), "th": np.concatenate(th), "gram": np.concatenate(gram), "near": np.concatenate(near), "pos": np.concatenate(pos), "again": np.concatenate(again)})

    return docs.mapInPandas(run, "doc long, th long, gram long, near long, pos long, again boolean")


def neighbourhoods(docs: DataFrame) -> DataFrame:
    """(gram, doc, th, pos, left, right, near) from (doc, th, text, at: array of gram and pos): near has LEFT bytes before
    the anchor and WINDOW from it on, padded with zeros; left and right say how many of them are text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text", 1 << 22):
            rows = []
            for d, h, t, at in zip(b["doc"], b["th"], b["text"], b["at"], strict=True):
                data = _bytes(t)
                for x in at:
                    p = x["pos"]
                    left, right = min(p, LEFT), min(len(data) - p, WINDOW)
                    rows.append((x["gram"], d, h, p, left, right, bytes(LEFT - left) + data[p - left : p + right] + bytes(WINDOW - right)))
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            yield pd.DataFrame(rows, columns=names)

    names = ["gram", "doc", "th", "pos", "left", "right", "near"]
    return docs.mapInPandas(run, "gram long, doc long, th long, pos long, left int, right int, near binary")


def _bucket(code: np.ndarray) -> np.ndarray:
    """Bucket numbers of equal codes, by sorting."""
    order = np.argsort(code)
    ordered = code[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _first_codes(near: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A hash of the STEP bytes from each position on, of the position and of the row's key."""
    code, size = _VALUE[near], 1
    while size < STEP:
        more = min(size, STEP - size)  # two runs that may overlap are equal if and only if the longer run is
        code[:, :-more] = code[:, :-more] * (_VALUE[size] | np.uint64(1)) + code[:, more:]
        size += more
    return mix(code + mix(key.view(np.uint64))[:, None] + _VALUE[: near.shape[1]])


def refine(key: np.ndarray, near: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, own: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For rows of neighbourhoods: a (row, window) flag for windows that a row of the same key has too and that is
    earlier: of a smaller doc, or of the same text (own) with a lower rank; rank goes by doc first, then own.
    Window o starts o bytes before the anchor; only o in low..high of a row are asked for."""
    rows, n = len(key), SPAN
    size, ids = STEP, None
    alive = np.arange(rows * n)  # places in the (row, position) grid whose bucket may still be shared
    lengths = [STEP]
    while lengths[-1] < WINDOW:
        lengths.append(min(2 * lengths[-1], WINDOW))
    for length in lengths:
        grid = np.full(rows * n, -1, np.int64)
        row, col = np.divmod(alive, n)
        ok = (col + length <= LEFT + right[row]) & (col >= LEFT - left[row])
        alive, row, col = alive[ok], row[ok], col[ok]
        if ids is None:
            got = _bucket(_first_codes(near, key).ravel()[alive])
        else:
            got = _bucket(ids[alive + (length - size)] << 32 | ids[alive])
        # Buckets of one are done; their neighbours can only be found in buckets that others share as well.
        count = np.bincount(got)
        shared = count[got] > 1
        alive, got = alive[shared], got[shared]
        grid[alive] = got
        ids, size = grid, length
        if not len(alive):
            return np.zeros((rows, W), bool)
        if length < WINDOW:
            step = min(2 * length, WINDOW) - length
            inside = alive % n + step < n
            alive = alive[inside]
            alive = alive[ids[alive + step] >= 0]
    row, col = np.divmod(alive, n)
    o = LEFT - col
    ok = (o >= low[row]) & (o <= high[row])
    alive, row, o = alive[ok], row[ok], o[ok]
    order = np.lexsort((rank[row], ids[alive]))
    bucket, row_of = ids[alive][order], row[order]
    same = np.zeros(len(order), bool)
    same[1:] = bucket[1:] == bucket[:-1]
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    later = doc[row_of] > doc[row_of[first]]
    later[1:] |= same[1:] & (own[row_of[1:]] == own[row_of[:-1]])
    out = np.zeros((rows, W), bool)
    hit = order[later]
    out[row[hit], o[hit]] = True
    return out


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    near = np.frombuffer(b"".join(rows["near"]), np.uint8).reshape(len(rows), SPAN)
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort((rows["pos"], rows["th"], rows["doc"]))] = np.arange(len(rows))
    own = rows.groupby(["doc", "th"]).ngroup().to_numpy()
    dup = refine(rows["key"].to_numpy(), near, rows["left"].to_numpy(), rows["right"].to_numpy(), rows["low"].to_numpy(), rows["high"].to_numpy(), rows["doc"].to_numpy(), own, rank)
    row, o = np.nonzero(dup)
    if not len(row):
        return pd.DataFrame({"doc": [], "th": [], "start": [], "end": []}).astype("int64")
    # Neighbouring windows of a row make one span.
    cut_at = np.flatnonzero((np.diff(row) != 0) | (np.diff(o) != 1)) + 1
    first, last = np.append(0, cut_at), np.append(cut_at - 1, len(row) - 1)
    pos = rows["pos"].to_numpy()[row[first]]
    return pd.DataFrame({"doc": rows["doc"].to_numpy()[row[first]], "th": rows["th"].to_numpy()[row[first]], "start": pos - o[last], "end": pos - o[first] + WINDOW})


def resolved(near: DataFrame) -> DataFrame:
    """(doc, th, start, end) of the repeated windows among the firsts of q-gram buckets."""
    spark = near.sparkSession
    rows = near.withColumns({"key": F.col("gram"), "low": F.lit(0), "high": F.lit(W - 1)})
    spans = None
    while True:
        sizes = rows.groupBy("key", "low", "high").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        rows = cut(rows.join(sizes, ["key", "low", "high"]), "buckets")
        total = rows.where(F.col("size") <= CROWD).count()
        calm = rows.where(F.col("size") <= CROWD)
        # A task takes several buckets: they are dealt by key, and each keeps its key inside.
        n = max(1, -(-total // CROWD), spark.sparkContext.defaultParallelism if total > CROWD else 1)
        dealt = calm.withColumn("task", F.pmod(F.xxhash64("key", "low", "high"), F.lit(n)).cast("int")).withColumn("key", F.xxhash64("key", "low", "high"))
        got = dealt.groupBy("task").applyInPandas(_repeats, "doc long, th long, start long, end long")
        spans = got if spans is None else spans.union(got)
        rows = rows.where(F.col("size") > CROWD).drop("size")
        if rows.isEmpty():
            return spans
        single = rows.where("low = high")
        # The same rule as in refine(): a smaller document has the window, or the same text has it further to the front.
        own = single.groupBy("key", "low", "doc", "th").agg(F.min("pos").alias("mine"))
        least = own.groupBy("key", "low").agg(F.min("doc").alias("least"))
        later = single.join(own, ["key", "low", "doc", "th"]).join(least, ["key", "low"]).where("doc > least or pos > mine")
        spans = spans.union(later.select("doc", "th", (F.col("pos") - F.col("low")).alias("start"), (F.col("pos") - F.col("low") + WINDOW).alias("end")))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct(F.col("low").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("high").alias("b")))
        rows = rows.where("low < high").withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.a"), "high": F.col("half.b")}).drop("half")
        # What all windows of the half have in common; a row whose text ends before that has none of them.
        rows = rows.where((F.col("left") >= F.col("low")) & (F.col("right") >= WINDOW - F.col("high")))
        core = F.substring(F.col("near"), F.lit(LEFT + 1) - F.col("low"), F.lit(WINDOW) - F.col("high") + F.col("low"))
        rows = rows.withColumn("key", F.xxhash64(core, "low", "high"))


def cut_out(data: bytes, spans: list) -> tuple[bytes, int, int]:
    """data without the spans (start, end), number of removed bytes and of removed runs."""
    if not len(spans):
        return data, 0, 0
    kept, done, removed, runs, stop = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if a > stop:
            kept.append(data[done:a])
            runs += 1
            removed += b - a
            done = stop = b
        elif b > stop:
            removed += b - stop
            done = stop = b
    kept.append(data[done:])
    return b"".join(kept), removed, runs


def identified(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(_key, doc, th, text): doc orders the rows, null ids lowest; th tells rows of one id apart, 0 where ids are unique.
    And (doc, th, text) without rows that repeat an id with its text: they would look like earlier copies of themselves."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    number = F.col("_key").cast("long")
    if not is_integral(rows, "_key"):
        rows, number = rows.join(numbers_of(rows, "_key"), "_key", "left"), F.col("_number")
    rows = rows.select("_key", F.coalesce(number, F.lit(_LOWEST)).alias("doc"), "text")
    unique = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if unique:
        rows = rows.withColumn("th", F.lit(0).cast("long"))
        return rows, rows.select("doc", "th", "text")
    rows = rows.withColumn("th", F.coalesce(F.xxhash64("text"), F.lit(0)))
    return rows, rows.select("doc", "th", "text").dropDuplicates(["doc", "th"])


def shared_marks(marks: DataFrame, wanted: str) -> DataFrame:
    """The marks (gram, near, doc, th, pos) whose q-gram fits `wanted`, by its smallest and largest document and count.
    Each step is written before the next shuffle, so the files of only one are on disk at a time."""
    sums = marks.groupBy("gram").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
    shared = cut(sums.where(wanted).select("gram"), "grams", tidy=True)
    return cut(marks.join(shared, "gram", "left_semi"), "shared", tidy=True)


def judged(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the marks of shared q-grams: those whose whole neighbourhood a smaller document has too, and the firsts of each
    neighbourhood where the q-gram has several."""
    first = cut(known.groupBy("gram", "near").agg(F.min("doc").alias("least")), "firsts", tidy=True)
    several = first.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram")
    met = cut(known.join(first, ["gram", "near"]), "judged", tidy=True)
    # Rows of one id are the same document in the order: neither is earlier, so all of them count as firsts.
    return met.where("doc > least").select("doc", "th", "pos"), met.where("doc = least").join(several, "gram", "left_semi").select("gram", "doc", "th", "pos")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc, th, spans) of all repeats in rows (doc, th, text), each pair of doc and th once."""
    marks = cut(anchor_table(rows), "anchors", tidy=True)
    repeats = cut(marks.where("again").select("doc", "th", "pos"), "repeats")
    shared = shared_marks(marks.where("not again").drop("again"), "n > 1")
    discard(marks)
    later, firsts = judged(shared)
    reach = [F.greatest(F.col("pos") - LEFT, F.lit(0)).alias("start"), (F.col("pos") + WINDOW).alias("end")]
    whole = later.union(repeats).select("doc", "th", *reach)
    wanted = firsts.groupBy("doc", "th").agg(F.collect_list(F.struct("gram", "pos")).alias("at"))
    near = cut(neighbourhoods(rows.join(wanted, ["doc", "th"])), "neighbourhoods", tidy=True)
    spans = cut(whole.union(resolved(near)), "spans", tidy=True)
    return spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept: binary) for each row of docs.

    Null texts are empty; texts under WINDOW bytes lose nothing.  A null id counts as the smallest.  Rows with the same
    id are equals, with the same text or another: none is earlier than the other, each loses what smaller ids or its own
    earlier bytes have.  Extra columns play no part.
    """
    rows, once = identified(docs, key, text)
    joined = rows.join(repeated_spans(once), ["doc", "th"], "left").select(F.col("_key").alias(key), "text", "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text", 1 << 22):
            out = []
            for t, spans in zip(b["text"], b["spans"], strict=True):
                data = _bytes(t)
                spans = [] if spans is None else [(s["start"], min(s["end"], len(data))) for s in spans]
                kept, removed, runs = cut_out(data, spans)
                out.append((len(data), removed, runs, kept))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"]).assign(**{key: b[key]})[[key, "n_bytes", "n_removed", "n_spans", "kept"]]

    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInPandas(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 100-byte strings."""
    kept = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op6_suffix_dedup": op6_suffix_dedup}
ORACLE: dict[str, str] = {}
