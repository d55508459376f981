"""Exact substring dedup over words, by level-wise doubling.

Every word goes that lies in a window of WORDS words whose word sequence also starts in a document with a smaller id.

Windows repeated at one length alone are extended to twice that length:

* Level 1, FIRST words: of the FIRST-word grams only those at anchors (winnow.py) are counted, at least one in each
  window of WORDS words.  Grams met in a single document are dropped.
* Beside the gram a hash of all words that can share a window with it is counted.  Where those are equal, all windows
  are repeats without further levels; only the first of each kind goes on.
* Level 2, twice the length: the windows of 2 * FIRST words around the anchors left; those met once are dropped.
* Level 3, WORDS: the windows around what is left; here the smallest id of each decides.

Each level is a count by hash with partial aggregates, so a passage shared by very many documents is one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, discard, hashed_words, mix, parts, powers, table
from glyphmill.llm.suffix import identified, judged, shared_marks
from glyphmill.llm.winnow import Prefix, anchors, sliding

WORDS, FIRST = 13, 4
#: Grams in a window; words before an anchor that can share a window with it.
W = WORDS - FIRST + 1
LEFT = W - 1
_STEP = powers(0xA0761D6478BD642F, 2 * FIRST + 1)[1:]


def _bytes(text: object) -> bytes:
    return text.encode("utf-8", "replace") if isinstance(text, str) else b""


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += words[k : k + n] * _STEP[k % len(_STEP)] ** np.uint64(1 + k // len(_STEP))
    return mix(out + np.uint64(size))


def found(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors (word numbers) of a text, the hashes of their grams and of their neighbourhoods."""
    _, _, words = hashed_words(np.frombuffer(data, np.uint8))
    if len(words) < WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    g = grams(words, FIRST)
    pos = anchors(g, W)
    left, right = np.maximum(pos - LEFT, 0), np.minimum(pos + WORDS, len(words))
    return pos, g[pos], Prefix(words)(left, right) + mix((pos - left).astype(np.uint64))


def anchor_table(rows: DataFrame) -> DataFrame:
    """(doc, th, gram, near, pos) from (doc, th, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text", 1 << 22):
            out = []
            for d, h, t in zip(b["doc"], b["th"], b["text"], strict=True):
                p, g, x = found(_bytes(t))
                if len(p):
                    out.append((np.full(len(p), d, np.int64), np.full(len(p), h, np.int64), g.view(np.int64), x.view(np.int64), p))
            if out:
                yield pd.DataFrame(dict(zip(("doc", "th", "gram", "near", "pos"), (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))

    return rows.mapInPandas(run, "doc long, th long, gram long, near long, pos long")


def window_table(rows: DataFrame) -> DataFrame:
    """(doc, th, start, half, full) from (doc, th, text, at: anchors): every window of WORDS words that holds one of the
    anchors, with its hash and that of the run of 2 * FIRST words in it whose hash is the smallest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text", 1 << 22):
            out = []
            for d, h, t, at in zip(b["doc"], b["th"], b["text"], b["at"], strict=True):
                _, _, words = hashed_words(np.frombuffer(_bytes(t), np.uint8))
                full = grams(words, WORDS)
                half = sliding(grams(words, 2 * FIRST), WORDS - 2 * FIRST + 1, np.minimum)
                start = np.unique((np.asarray(at, np.int64)[:, None] - np.arange(W)).ravel())
                start = start[(start >= 0) & (start < len(full))]
                out.append((np.full(len(start), d, np.int64), np.full(len(start), h, np.int64), start, half[start].view(np.int64), full[start].view(np.int64)))
            if out:
                yield pd.DataFrame(dict(zip(("doc", "th", "start", "half", "full"), (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))

    return rows.mapInPandas(run, "doc long, th long, start long, half long, full long")


def _met_twice(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key is met in two documents or more, with the smallest."""
    facts = rows.groupBy(key).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least <> most")
    return rows.join(facts.select(key, "least"), key)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc, th, spans) of all repeats in rows (doc, th, text); spans are word numbers (start, end)."""
    marks = cut(anchor_table(rows), "anchors", tidy=True)
    shared = shared_marks(marks, "least <> most")
    discard(marks)
    later, firsts = judged(shared)
    whole = later.select("doc", "th", F.greatest(F.col("pos") - LEFT, F.lit(0)).alias("start"), (F.col("pos") + WORDS).alias("end"))

    wanted = firsts.groupBy("doc", "th").agg(F.collect_list("pos").alias("at"))
    level2 = cut(window_table(rows.join(wanted, ["doc", "th"])), "windows", tidy=True)
    level3 = cut(_met_twice(level2, "half").drop("least"), "windows", tidy=True)
    again = _met_twice(level3, "full").where("doc > least").select("doc", "th", "start", (F.col("start") + WORDS).alias("end"))
    return cut(whole.union(again), "spans", tidy=True).groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def dedup_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept) for each row of docs; kept: the words left, joined by one blank.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged.  Null texts have none; texts under WORDS words lose nothing.  A null id
    counts as the smallest.  Rows with the same id are one document in the order: they take nothing from each other.
    Extra columns play no part.
    """
    rows, once = identified(docs, key, text)
    joined = rows.join(repeated_spans(once), ["doc", "th"], "left").select(F.col("_key").alias(key), "text", "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text", 1 << 22):
            out = []
            for t, spans in zip(b["text"], b["spans"], strict=True):
                words = _bytes(t).split()  # bytes split at just these six
                keep = np.ones(len(words) + 1, np.int64)
                if spans is not None and len(spans):
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, [s["start"] for s in spans], 1)
                    np.add.at(step, [min(s["end"], len(words)) for s in spans], -1)
                    keep = np.cumsum(step) == 0
                left = [w for w, k in zip(words, keep, strict=False) if k]
                out.append((len(words), len(words) - len(left), b" ".join(left).decode()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept"]).assign(**{key: b[key]})[[key, "n_words", "n_removed", "kept"]]

    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInPandas(run, f"`{key}` {kind}, n_words long, n_removed long, kept string")


def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages."""
    kept = dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op7_passage_dedup": op7_passage_dedup}
ORACLE: dict[str, str] = {}
