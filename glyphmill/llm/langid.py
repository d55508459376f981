"""Language identification by prediction by partial matching (PPM).

For each language a variable-order context tree over UTF-8 bytes is counted once on a bounded sample and then frozen.
The code length of a text is the sum over its bytes of -log2 of the byte's probability in the longest context that the
tree holds; a byte not seen there pays the escape of that context and goes on in the next shorter one, down to one
chance in 256.  Escapes are by method C (distinct followers against all followers).  The language with the shortest
code wins.

The frozen tree is sparse: a row for each context, with a bitmap of the byte classes that follow it in any language and
one entry for each of those, holding the code length in every language with all escapes already added.  A map from the
last ORDER byte classes gives the row of the longest context held; a byte that isn't in its bitmap pays the escapes of
the row and goes on in the row of the next shorter context.  So most bytes take one look-up, and scoring needs no state
between rows: a plain map over the input, without shuffle, where a lost executor costs only its own tasks.

The sample's texts are counted whole, by the executors; what reaches the driver are the counts of a language's sample,
which SAMPLE_CHARS bounds, and all of them are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.llm.common import cut, discard, fold, parts, table

ORDER = 3
LETTER = regex.compile(r"\p{L}")
#: A text is scored in runs of this many bytes, so memory doesn't depend on its length.
RUN_BYTES = 1 << 18
#: Characters a language in the sample, which bound what its tree can hold; the text that crosses it is the last one taken.
SAMPLE_CHARS = 1_000_000
_PAD = b"\n" * ORDER


@dataclass
class PPM:
    """Frozen statistics.  classes: byte -> class, 0 for bytes never seen; rows: last ORDER classes -> row; up: row -> row
    of the next shorter context (-1: none); bits: the classes that follow a row's context, as a bitmap in words of 64;
    first: number of the first entry of such a word; cost: bits of an entry in each language; escape: those of a row."""

    langs: list[str]
    classes: np.ndarray
    rows: np.ndarray
    up: np.ndarray
    bits_: np.ndarray
    first: np.ndarray
    cost: np.ndarray
    escape: np.ndarray

    def entries(self, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Number of the entry of each (row, class), -1 where there is none."""
        return _entries(self.bits_, self.first, row, symbol)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        batch, size = [], 0
        for i, t in enumerate(texts):
            for at in range(0, len(t), RUN_BYTES):
                head = t[max(0, at - ORDER) : at]
                run = _PAD[len(head) :] + head + t[at : at + RUN_BYTES]
                if size + len(run) > RUN_BYTES and batch:
                    self._add(out, batch)
                    batch, size = [], 0
                batch.append((i, run))
                size += len(run)
        if batch:
            self._add(out, batch)
        return out

    def _add(self, out: np.ndarray, batch: list[tuple[int, bytes]]) -> None:
        a = int(self.classes.max()) + 1
        c = self.classes[np.frombuffer(b"".join(x for _, x in batch), np.uint8)]
        n = len(c) - ORDER
        context = np.zeros(n, np.int64)
        for k in range(ORDER):
            context *= a
            context += c[k : n + k]
        row, symbol = self.rows[context], c[ORDER:]
        at = self.entries(row, symbol)
        missed = np.flatnonzero(at < 0)
        rest = _climbed(self, row[missed], symbol[missed])
        ends = np.cumsum([len(x) for _, x in batch])
        edges = np.empty(2 * len(batch), np.int64)
        edges[0::2], edges[1::2] = np.concatenate([[0], ends[:-1]]), ends - ORDER
        owner = [i for i, _ in batch]
        value = np.zeros(n + 1, np.float32)
        for k in range(len(self.langs)):
            np.take(self.cost[k], at, out=value[:n], mode="wrap")
            value[missed] = rest[k]
            np.add.at(out[:, k], owner, np.add.reduceat(value, edges, dtype=np.float64)[0::2])


def _entries(bits: np.ndarray, first: np.ndarray, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    at = row * np.int64(bits.shape[1]) + (symbol >> 6)
    word, place = bits.ravel()[at], (symbol & 63).astype(np.uint64)
    below = np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
    return np.where((word >> place) & np.uint64(1), first.ravel()[at] + below, -1)


def _climbed(model: PPM, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Bits in each language of classes that do not follow the context of their row."""
    out = np.zeros((len(model.langs), len(row)), np.float32)
    left = np.arange(len(row))
    while len(left):
        out[:, left] += model.escape[:, row]
        row = model.up[row]
        out[:, left[row < 0]] += 8.0
        left, row, symbol = left[row >= 0], row[row >= 0], symbol[row >= 0]
        at = model.entries(row, symbol)
        met = at >= 0
        out[:, left[met]] += model.cost[:, at[met]]
        left, row, symbol = left[~met], row[~met], symbol[~met]
    return out


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the texts with the ORDER bytes before it (line feeds before the first) as one number, counted."""
    out: dict[int, int] = {}
    for t in texts:
        for at in range(0, len(t), 1 << 22):
            head = t[max(0, at - ORDER) : at]
            x = np.frombuffer(_PAD[len(head) :] + head + t[at : at + (1 << 22)], np.uint8).astype(np.uint32)
            n = len(x) - ORDER
            code = np.zeros(n, np.uint32)
            for k in range(ORDER + 1):
                code = code << np.uint32(8) | x[k : n + k]
            for g, m in zip(*(y.tolist() for y in np.unique(code, return_counts=True)), strict=True):
                out[g] = out.get(g, 0) + m
    return np.fromiter(out, np.uint32, len(out)), np.fromiter(out.values(), np.int64, len(out))


def train(counts: dict[str, tuple[np.ndarray, np.ndarray]], min_count: int = 3) -> PPM:
    """The model of gram_counts() of each language.  Contexts of two or more bytes met fewer than min_count times in every
    language are left out."""
    langs = sorted(counts)
    seen = np.zeros(256, bool)
    seen[10] = True
    for grams, _ in counts.values():
        for k in range(ORDER + 1):
            seen[grams >> np.uint32(8 * k) & np.uint32(255)] = True
    classes = np.zeros(256, np.int64)
    classes[seen] = np.arange(1, seen.sum() + 1)
    a = int(seen.sum()) + 1
    width = -(-a // 64)
    model = PPM(langs, classes, np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.uint64), np.zeros((0, width), np.int64), np.zeros((len(langs), 0), np.float32), np.zeros((len(langs), 0), np.float32))
    for order in range(ORDER + 1):
        pairs, contexts = [], []
        for l in langs:
            grams, n = counts[l]
            code = np.zeros(len(grams), np.int64)
            for k in range(order, -1, -1):
                code = code * a + classes[grams >> np.uint32(8 * k) & np.uint32(255)]
            code, at = np.unique(code, return_inverse=True)
            n = np.bincount(at, n, len(code)).astype(np.int64) if len(code) else np.zeros(0, np.int64)
            context, at = np.unique(code // a, return_inverse=True)
            total = np.bincount(at, n, len(context)) if len(context) else np.zeros(0)
            contexts.append(context[total >= (1 if order < 2 else min_count)])
            pairs.append((code, n))
        held = np.unique(np.concatenate(contexts)) if order else np.zeros(1, np.int64)
        if not len(held):  # too little was met: this order, and with it all longer ones, says nothing
            model.rows = np.tile(model.rows, a)
            continue
        base = len(model.up)
        if order:
            up = model.rows[held % a ** (order - 1)]
            model.rows = np.tile(model.rows, a)
            model.rows[held] = base + np.arange(len(held))
        else:
            up = np.array([-1])

        def place(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Which codes have a context that is held, and its number."""
            i = np.minimum(np.searchsorted(held, code // a), len(held) - 1)
            return held[i] == code // a, i

        known = np.unique(np.concatenate([code[place(code)[0]] for code, _ in pairs]))
        row, symbol = place(known)[1], known % a
        # Where a language hasn't met the class in this context: its escape and what the shorter context says.
        cost = np.full((len(langs), len(known)), 8.0, np.float32)
        if order:
            at = model.entries(up[row], symbol)
            cost = np.where(at >= 0, model.cost[:, at], _climbed(model, up[row], symbol))
        escape = np.zeros((len(langs), len(held)), np.float32)
        for j, (code, n) in enumerate(pairs):
            ok, i = place(code)
            code, n, i = code[ok], n[ok], i[ok]
            total, kinds = np.bincount(i, n, len(held)), np.bincount(i, minlength=len(held))
            met = total > 0
            escape[j, met] = -np.log2(kinds[met] / (total[met] + kinds[met]))
            cost[j] += escape[j, row]
            cost[j, np.searchsorted(known, code)] = -np.log2(n / (total[i] + kinds[i]))
        bits = np.zeros((len(held), width), np.uint64)
        np.bitwise_or.at(bits, (row, symbol >> 6), np.uint64(1) << (symbol & 63).astype(np.uint64))
        held_before = np.cumsum(np.bitwise_count(bits).ravel().astype(np.int64))
        first = model.cost.shape[1] + np.concatenate([[0], held_before[:-1]]).reshape(len(held), width)
        model.up = np.concatenate([model.up, up])
        model.bits_, model.first = np.concatenate([model.bits_, bits]), np.concatenate([model.first, first])
        model.cost, model.escape = np.concatenate([model.cost, cost], axis=1), np.concatenate([model.escape, escape], axis=1)
    return model


def sampled_counts(docs: DataFrame, text: str, lang: str, key: str, per_lang: int, langs: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """gram_counts() of at most per_lang whole texts of each of langs, picked by a hash of their key, until SAMPLE_CHARS
    characters of a language are reached."""
    fit = docs.where(F.col(lang).isin(langs) & F.col(text).rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy("h", "key")
    picked = (
        fit.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.xxhash64(F.col(key).cast("string")).alias("h"), F.length(text).alias("size"))
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= per_lang)
        .withColumn("before", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .where(F.col("before") < SAMPLE_CHARS)
        .select(F.col("lang").alias("_lang"), F.col("key").alias("_key"))
        .limit(per_lang * len(langs))
        .distinct()
    )
    rows = fit.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(picked), F.col("key").eqNullSafe(F.col("_key")) & (F.col("lang") == F.col("_lang"))).select("lang", "key", "text")
    rows = rows.groupBy("lang", "key").agg(F.min("text").alias("text"))  # however often a key is repeated

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text"):
            found = [gram_counts([t.encode("utf-8", "replace")]) for t in b["text"]]
            yield pd.DataFrame({"lang": b["lang"], "grams": [g.tobytes() for g, _ in found], "n": [n.tobytes() for _, n in found]})

    def merge(some: pd.DataFrame) -> pd.DataFrame:  # per_lang rows at most
        grams, at = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in some["grams"]]), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.frombuffer(x, np.int64) for x in some["n"]]), len(grams)).astype(np.int64)
        return pd.DataFrame({"lang": [some["lang"].iloc[0]], "grams": [grams.tobytes()], "n": [n.tobytes()]})

    schema = "lang string, grams binary, n binary"
    found = rows.select("lang", "text").mapInPandas(count, schema).groupBy("lang").applyInPandas(merge, schema)
    return {r["lang"]: (np.frombuffer(r["grams"], np.uint32), np.frombuffer(r["n"], np.int64)) for r in found.collect()}


def identify(
    docs: DataFrame, train_rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = 250, langs_a_pass: int = 16
) -> DataFrame:
    """docs with the columns lang_pred, score (the predicted language's posterior under equal priors) and bits_per_byte (its
    code length; 8 is what knowing nothing takes, 0 is given for `und`) added.

    The trees are fitted on at most per_lang whole texts (or SAMPLE_CHARS characters) of each language of train_rows; however
    few there are, they are learned from.  Every row of docs is scored over its whole text in every language: langs_a_pass languages are learned and scored at once, and with more, docs are written with their best
    language so far after each pass.  Null texts and texts without a letter get `und` and score 0, as does every
    text where train_rows gives nothing to learn.  Ties go to the language that sorts first.  Repeated rows are kept.
    Columns of docs named like the added ones are replaced; others pass through untouched.
    """
    spark = docs.sparkSession
    counts = train_rows.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    langs = [r["l"] for r in counts.orderBy(F.desc("n"), "l").collect()]
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    docs = docs.select(*(F.col(f"`{c}`") for c in keep))
    least = "_bits"
    while least in keep:
        least = f"_{least}"
    # Between passes: the best language so far, its bits, and the sum of 2 ** (its bits - bits) over all languages.
    state = {"lang_pred": F.lit("x"), "score": F.lit(0.0), least: F.lit(0.0)}
    passes = [langs[k : k + langs_a_pass] for k in range(0, len(langs), langs_a_pass)] or [[]]
    made = None
    for k, some in enumerate(passes):
        counts = sampled_counts(train_rows, text, lang, key, per_lang, some) if some else {}
        shared = spark.sparkContext.broadcast(train(counts) if counts else None)
        docs = docs.mapInPandas(_scored(shared, text, least, k == 0, k == len(passes) - 1), (docs.withColumns(state) if k == 0 else docs).schema)
        if k < len(passes) - 1:
            docs, before = cut(docs, "languages"), made
            if before is not None:
                discard(before)
            made = docs
            shared.destroy()
    return docs.select(*(F.col(f"`{c}`") for c in keep), "lang_pred", "score", F.col(least).alias("bits_per_byte"))


def _scored(shared, text: str, bits_so_far: str, first: bool, last: bool):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for b in parts(batches, text):
            texts = b[text].tolist()
            at = [i for i, t in enumerate(texts) if isinstance(t, str) and model is not None and LETTER.search(t)]
            if first:
                pred, p, least = np.full(len(b), "und", object), np.zeros(len(b)), np.full(len(b), np.inf)
            else:
                pred, p, least = b["lang_pred"].to_numpy(object).copy(), b["score"].to_numpy().copy(), b[bits_so_far].to_numpy().copy()
            if at:
                bits = model.bits([texts[i].encode("utf-8", "replace") for i in at])
                best, low = np.array(model.langs, object)[bits.argmin(1)], bits.min(1)
                total = np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
                old, had = least[at], pred[at]
                wins = (low < old) | ((low == old) & (best < had))
                both = np.minimum(low, old)
                p[at] = p[at] * np.exp2(np.maximum(both - old, -1000)) + total * np.exp2(np.maximum(both - low, -1000))
                pred[at], least[at] = np.where(wins, best, had), both
            if last:
                p = np.divide(1.0, p, out=np.zeros(len(p)), where=p > 0)
                known = np.isfinite(least)
                n = np.array([len(t.encode("utf-8", "replace")) if k else 1 for t, k in zip(texts, known, strict=True)])
                least = np.where(known, least / n, 0.0)
            yield b.assign(**{"lang_pred": pred, "score": p, bits_so_far: least})

    return score


def op10_langid_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; trees learn only from documents whose fold of 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = docs.withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    found = identify(rows.select("doc_id", "text", "held_out"), rows.where(~F.col("held_out")))
    return found.select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op10_langid_ppm": op10_langid_ppm}
ORACLE: dict[str, str] = {}
