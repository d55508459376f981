"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is a logistic function of the weights of its words; the
document's is the noisy-or of its sentences, 1 - prod(1 - p).  Only documents are labelled: the weights are fitted so
that the noisy-or matches the labels, and the sentences that carry a document's score are thereby located.

Features of a word are the word itself and its first 4 to 7 letters, so inflected forms share evidence.  Weights are
not negative: words can add to the suspicion of a sentence but clean words can't talk it away, and a sentence without
any known feature has probability 0, so length alone never makes a document toxic.

Fitting takes a bounded sample of labelled rows: whole texts picked by a hash of the id, PER_LABEL of each label at most
and no more than SAMPLE_CHARS characters of each.  Executors count their features and turn their sentences into numbers of
the features kept; only those numbers reach the driver.  Scoring is a plain map over all documents, whole texts, sentence
by sentence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.llm.common import cut, fold, parts, table

#: Labelled documents of each label in the fit, and characters (the first document counts whatever its length).
PER_LABEL, SAMPLE_CHARS = 4000, 40_000_000
#: Features kept: fewer than 2**15, by whose numbers sentences come to the driver.
STEMS, MAX_FEATURES, LEAST_MET = (4, 5, 6, 7), 4000, 3
MAX_WORDS = 200_000
WORD, SENTENCE = re.compile(r"[^\W\d_]+"), re.compile(r"[^.!?\n]+")


def features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


def sentences(text: str) -> Iterator[list[str]]:
    """The words of each sentence."""
    for s in SENTENCE.finditer(text):
        yield WORD.findall(s[0].lower())


def fit(bags: list[np.ndarray], labels: np.ndarray, n_features: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights of features and the bias.  A bag is a document: the feature numbers of its sentences one after the other,
    each sentence closed by -1; labels are 0 and 1."""
    y = labels.astype(bool)
    flat = np.concatenate(bags) if bags else np.zeros(0, np.int32)
    of = np.repeat(np.arange(len(bags)), [len(x) for x in bags])
    closed = flat < 0
    bag_of = of[closed]
    column = flat[~closed]
    sentence = np.cumsum(closed)[~closed]
    n1, n0 = y.sum(), (~y).sum()
    # The bias comes last; Adam with projection to weights that aren't negative.
    w = np.append(np.full(n_features, 0.5), -6.0)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = np.bincount(sentence, w[column], len(bag_of)) + w[-1]
        p = np.clip(1 / (1 + np.exp(-z)), 1e-12, 1 - 1e-9)
        clean = np.bincount(bag_of, np.log1p(-p), len(bags))  # log of the chance that no sentence is toxic
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        pull = np.where(y, -np.exp(clean) / toxic / n1, 1 / n0)  # both labels weigh alike
        dz = pull[bag_of] * p
        g = np.append(np.bincount(column, dz[sentence], n_features) + 2e-5 * w[:-1] + 1e-5, dz.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w[:-1] = np.maximum(w[:-1], 0)
        w[-1] = min(w[-1], -4.0)
    return w[:-1], float(w[-1])


class Scorer:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.words = weights, bias, {}

    def word(self, w: str) -> float:
        if len(self.words) > MAX_WORDS:
            self.words = {}
        x = self.words[w] = sum(self.weights.get(f, 0.0) for f in features(w))
        return x

    def score(self, text: str) -> tuple[float, int, int, int, float]:
        """Document score, offending sentences, span and score of the worst sentence (-1, -1, 0 if none)."""
        clean, offending, worst = 0.0, 0, (0.0, -1, -1)
        get = self.words.get
        for s in SENTENCE.finditer(text):
            z = 0.0
            for w in WORD.findall(s[0].lower()):
                x = get(w)
                z += self.word(w) if x is None else x
                get = self.words.get
            if z > 0:
                p = 1 / (1 + math.exp(-min(z + self.bias, 30.0)))
                clean += math.log1p(-p)
                offending += p >= 0.5
                if p > worst[0]:
                    worst = (p, s.start(), s.end())
        return 0.0 - math.expm1(clean), offending, worst[1], worst[2], float(worst[0])


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int) -> DataFrame:
    """(label, text) of the labelled documents to learn from; an id labelled both ways counts as toxic, and of several
    texts under one id one is taken."""
    given = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    facts = texts.select("_id", F.xxhash64("_text").alias("_h"), F.length("_text").alias("_n")).join(given, F.col("_id") == F.col("_key"))
    facts = facts.groupBy("_id", "_label").agg(F.min(F.struct("_h", "_n")).alias("one")).select("_id", "_label", "one.*")
    order = (F.xxhash64(F.col("_id").cast("string")), F.col("_id"))
    some = [facts.where(F.col("_label") == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    # These rows are few: the characters before each are added up in one place.
    before = F.sum("_n").over(Window.partitionBy("_label").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    picked = some[0].union(some[1]).withColumn("_before", F.coalesce(before, F.lit(0)))
    picked = picked.where((F.col("_before") == 0) | (F.col("_before") + F.col("_n") <= SAMPLE_CHARS)).select(F.col("_id").alias("_key"), "_h", "_label")
    same = (F.col("_id") == F.col("_key")) & (F.xxhash64("_text") == F.col("_h"))
    return texts.join(F.broadcast(picked), same).groupBy("_id", F.col("_label").alias("label")).agg(F.min("_text").alias("text")).select("label", "text")


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int) -> tuple[dict[str, float], float]:
    """Weights of features and the bias; nothing where a label has no documents."""
    picked = cut(sample(docs, labels, key, text, label, per_label), "sample")
    sizes = {r["label"]: r["n"] for r in picked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return {}, 0.0

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, "text"):
            for y in (0, 1):
                seen = Counter()
                for t in b["text"][b["label"] == y]:
                    seen.update({f for w in {w for s in sentences(t) for w in s} for f in features(w)})
                yield pd.DataFrame({"feature": list(seen), "n1": [n * y for n in seen.values()], "n0": [n * (1 - y) for n in seen.values()]})

    n1, n0 = sizes[1], sizes[0]
    counts = picked.mapInPandas(met, "feature string, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    lift = F.col("n1") / n1 * F.log((F.col("n1") + 0.5) / (n1 + 1) * (n0 + 1) / (F.col("n0") + 0.5))
    counts = counts.withColumn("lift", lift).where((F.col("n1") >= LEAST_MET) & (F.col("lift") > 0))
    kept = [r["feature"] for r in counts.orderBy(F.desc("lift"), "feature").limit(MAX_FEATURES).collect()]
    number = {f: i for i, f in enumerate(kept)}

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_word: dict[str, list[int]] = {}
        for b in parts(batches, "text"):
            out = []
            for t in b["text"]:
                bag = []
                for words in sentences(t):
                    before = len(bag)
                    for w in words:
                        if w not in of_word:
                            of_word[w] = [number[f] for f in features(w) if f in number]
                        bag += of_word[w]
                    if len(bag) > before:
                        bag.append(-1)
                out.append(np.array(bag, np.int16).tobytes())
                if len(of_word) > MAX_WORDS:
                    of_word.clear()
            yield pd.DataFrame({"label": b["label"], "bag": out})

    rows = picked.mapInPandas(numbered, "label int, bag binary").collect()
    rows = sorted((r["label"], bytes(r["bag"])) for r in rows)  # the same order whatever the partitions
    weights, bias = fit([np.frombuffer(x, np.int16) for _, x in rows], np.array([y for y, _ in rows]), len(kept))
    return {f: float(x) for f, x in zip(kept, weights, strict=True) if x > 0.05}, bias


def toxicity(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = PER_LABEL) -> DataFrame:
    """docs with score, predicted (score >= 0.5), n_offending, worst_start, worst_end and worst_score added.

    labels has key and label (0 or 1; other values and nulls are ignored) for some rows of train_docs.  Texts without a
    sentence with known features - null and empty ones too - score 0, as all do where a label has no rows to learn from.
    Repeated rows are each scored.  Columns of docs named like the added ones are replaced.
    """
    names = ("score", "predicted", "n_offending", "worst_start", "worst_end", "worst_score")
    shared = docs.sparkSession.sparkContext.broadcast(learn(train_docs, labels, key, text, label, per_label))
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*shared.value)
        for b in parts(batches, text):
            rows = [scorer.score(t) if isinstance(t, str) else (0.0, 0, -1, -1, 0.0) for t in b[text]]
            score = np.array([r[0] for r in rows], float)
            yield b.assign(score=score, predicted=(score >= 0.5).astype("int32"), n_offending=[int(r[1]) for r in rows], worst_start=[r[2] for r in rows], worst_end=[r[3] for r in rows], worst_score=[r[4] for r in rows])

    kinds = dict(zip(names, ("double", "int", "long", "long", "long", "double"), strict=True))
    return docs.mapInPandas(run, docs.withColumns({c: F.lit(0).cast(k) for c, k in kinds.items()}).schema)


def op1_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned only from documents whose fold of 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id"), 5) != 0)
    found = toxicity(docs, docs.where(~F.col("held_out")), labels)
    return found.select("doc_id", "held_out", "score", "predicted", "n_offending", "worst_start", "worst_end", "worst_score")


QUERIES = {"op1_toxicity_mil": op1_toxicity_mil}
ORACLE: dict[str, str] = {}
