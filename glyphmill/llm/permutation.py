"""Nearest neighbours by a permutation index.

A vector is represented by the order of the pivots by their distance from it, of which the first PREFIX are kept.

1. Pivots are vectors spread apart, each the furthest from those before it in a bounded sample picked by hash; their
   number grows with the root of the vectors'.  Near copies give one pivot.
2. Every vector is posted, with its order, in the inverted files of its POSTED nearest pivots.  A file of more than FILE
   postings is dealt out by hash, and queries go to each part of it.
3. A query opens the files of its nearest pivots (OPENED, or an OPEN_SHARE of all) and ranks what it meets there by the
   footrule distance: the sum of the differences of a pivot's places in both orders, a missing place counting as PREFIX.
   A pair that shares several files is looked at in the query's nearest one.
4. Those within the query's best go on; how many that is (`wanted`) grows with the 0.7th power of the number of vectors.
   Where that rank lies is told by the footrule distances from the sample, so nothing has to be gathered to know it.
5. They are ranked anew by exact distances: pairs are joined with the vectors by entry and with the queries by query, and
   each task keeps the best of a query before they are brought together.

A pivot that is the nearest of more than CROWDED of all vectors - a hot group of near copies, whose orders are alike - has
an index of its own with pivots of its own, searched by the queries that open its file.  A query that found too few is
searched again with every file open, so a full result is never missed.

Equal vectors are one entry: a class with its smallest ids, as many as a result can hold.  So a vector that a third of
all rows share costs one entry, and its ties are exact.  Every row is indexed; only the pivots come from a sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.llm.common import cut, is_integral, numbers_of, table

PREFIX, POSTED, OPENED, OPEN_SHARE = 96, 8, 64, 1 / 16
#: Most pivots; vectors that each is picked out of.
PIVOTS, PER_PIVOT = 4096, 4
FILE = 8192
#: Bytes of query vectors that are sent to every task.
SMALL = 32 << 20
#: Share of all vectors (and number) from which a pivot's own ones get an index of their own, and how deep that may go.
CROWDED, CROWD, DEPTH = 1 / 8, 400, 6
#: Candidates a query that are ranked anew: LEAST, or FACTOR times the 0.7th power of the number of vectors.
LEAST, FACTOR = 150, 0.8


def usable(vector: Column) -> Column:
    """Not null, without null, infinite or not-a-number components, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """n vectors of the sample, each the furthest from those before it; all of them if there are no more."""
    at, gap = [0], np.full(len(sample), np.inf)
    while len(at) < min(n, len(sample)):
        gap = np.minimum(gap, ((sample - sample[at[-1]]) ** 2).sum(1))
        gap[at[-1]] = -1.0
        at.append(int(gap.argmax()))
    return sample[at]


def orders(vectors: np.ndarray, pivots: np.ndarray, size: int = PREFIX) -> np.ndarray:
    """The `size` nearest pivots of each vector, nearest first; ties go to the earlier pivot."""
    out, size = [], min(size, len(pivots))
    for at in range(0, len(vectors), 1024):
        near = (pivots * pivots).sum(1) - 2 * (vectors[at : at + 1024] @ pivots.T)
        first = np.sort(np.argpartition(near, size - 1, axis=1)[:, :size], axis=1)
        out.append(np.take_along_axis(first, np.argsort(np.take_along_axis(near, first, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out).astype(np.int16)


def places(order: np.ndarray, n_pivots: int) -> np.ndarray:
    """The place of each pivot in one order; the order's length where it isn't in it."""
    out = np.full(n_pivots, len(order), np.int32)
    out[order] = np.arange(len(order))
    return out


def footrule(place: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Distance of the order with these places from each of the found orders, up to a constant."""
    size = found.shape[1]
    own = place[found]
    return (np.abs(own - np.arange(size)) + own - size).sum(1) + size * (size - 1) // 2


def wanted(n: int) -> int:
    """How many of n vectors are ranked anew by exact distances."""
    return max(LEAST, int(FACTOR * n**0.7))


def candidates(index: DataFrame, asked: DataFrame, n: int, depth: int = 0, whole: bool = False) -> DataFrame:
    """(qcid, cid) of what the queries asked (qcid, v) find in index (cid, v) of n vectors.  With whole, every file is
    opened and nothing is left out."""
    spark = index.sparkSession
    n_pivots = max(1, min(PIVOTS, int(4 * n**0.5)))
    sample = np.array([r["v"] for r in index.orderBy(F.xxhash64("cid", F.lit(7)), "cid").limit(PER_PIVOT * n_pivots).select("v").collect()])
    pivots = spread(sample, n_pivots)
    n_pivots = len(pivots)
    known = orders(sample, pivots)
    n_opened = n_pivots if whole else max(OPENED, int(OPEN_SHARE * n_pivots))
    shared = spark.sparkContext.broadcast(pivots)

    def posted(batches):
        for b in batches:
            if len(b):
                found = orders(np.stack(b["v"]), shared.value)
                yield pd.DataFrame({"cid": b["cid"], "prefix": [x.tobytes() for x in found], "files": [x[:POSTED].astype(np.int32) for x in found]})

    postings = cut(index.select("cid", "v").mapInPandas(posted, "cid long, prefix binary, files array<int>"), "postings")
    home = F.element_at("files", 1)
    homes = {r["home"]: r["n"] for r in postings.groupBy(home.alias("home")).agg(F.count(F.lit(1)).alias("n")).collect()}
    crowded = [] if whole or depth == DEPTH else sorted(p for p, m in homes.items() if m > max(CROWD, CROWDED * n))
    calm = postings.where(~home.isin(crowded)) if crowded else postings
    n_calm = n - sum(homes[p] for p in crowded)
    rest = known[~np.isin(known[:, 0], crowded)] if crowded else known
    share = 1.0 if whole else min(1.0, wanted(n_calm) / max(n_calm, 1))
    of_sample = spark.sparkContext.broadcast(rest)

    def opened(batches):
        for b in batches:
            if len(b):
                found = orders(np.stack(b["v"]), shared.value, max(PREFIX, n_opened))
                limit = []
                for x in found:
                    gap = np.sort(footrule(places(x[:PREFIX], n_pivots), of_sample.value)) if share < 1 and len(of_sample.value) else []
                    limit.append(int(gap[min(len(gap) - 1, int(share * len(gap)))]) if len(gap) else 1 << 30)
                yield pd.DataFrame({"qcid": b["qcid"], "prefix": [x.tobytes() for x in found], "files": [x[:n_opened].astype(np.int32) for x in found], "most": limit})

    queries = cut(asked.select("qcid", "v").mapInPandas(opened, "qcid long, prefix binary, files array<int>, most long"), "opened")
    files = calm.select(F.explode("files").alias("file"), "cid", "prefix")
    sizes = F.broadcast(files.groupBy("file").agg(F.ceil(F.count(F.lit(1)) / FILE).cast("int").alias("n_parts")))  # a row a pivot
    right = files.join(sizes, "file").select("file", F.pmod(F.xxhash64("cid"), "n_parts").cast("int").alias("part"), "cid", "prefix")
    left = queries.select(F.explode("files").alias("file"), "qcid", "prefix", "most").join(sizes, "file")
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).drop("n_parts")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"qcid": [], "cid": []}
        if len(left) and len(right):
            read = lambda x: np.frombuffer(b"".join(x), np.int16).reshape(len(x), -1)
            found, ids, here = read(right["prefix"]), right["cid"].to_numpy(), left["file"].iloc[0]
            for q, order, most in zip(left["qcid"], read(left["prefix"]), left["most"], strict=True):
                place = places(order[:n_opened], n_pivots)
                at = np.flatnonzero(place[found[:, :POSTED]].min(1) == place[here])  # the pair's first shared file
                at = at[footrule(places(order[:PREFIX], n_pivots), found[at]) <= most]
                out["qcid"].append(np.full(len(at), q))
                out["cid"].append(ids[at])
        return pd.DataFrame({k: np.concatenate(x) if x else np.zeros(0, np.int64) for k, x in out.items()})

    met = left.groupBy("file", "part").cogroup(right.groupBy("file", "part")).applyInPandas(search, "qcid long, cid long")
    for p in crowded:
        inside = cut(index.join(postings.where(home == p).select("cid"), "cid"), "crowded")
        theirs = asked.join(queries.where(F.array_contains("files", p)).select("qcid"), "qcid")
        met = met.union(candidates(inside, theirs, homes[p], depth + 1))
    return met


def ranked(pairs: DataFrame, index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(qcid, cid, score): the k nearest of the pairs of each query, by exact distances.  Pairs meet the vectors by cid and
    the queries by qcid; queries of SMALL bytes or less go to every task in place of a second shuffle."""
    met = pairs.join(index.select("cid", "v"), "cid")
    size = asked.agg(F.coalesce(F.sum(F.size("v")) * 8, F.lit(0)).alias("n")).first()["n"]
    if size <= SMALL:
        rows = asked.select("qcid", "v").collect()
        ids = np.array([r["qcid"] for r in rows], np.int64)
        order = np.argsort(ids)
        shared = index.sparkSession.sparkContext.broadcast((ids[order], np.array([r["v"] for r in rows])[order]))

        def near(batches):
            for b in batches:
                if len(b):
                    ids, vectors = shared.value
                    gap = np.stack(b["v"]) - vectors[np.searchsorted(ids, b["qcid"].to_numpy())]
                    yield pd.DataFrame({"qcid": b["qcid"], "cid": b["cid"], "score": np.sqrt((gap**2).sum(1))})

    else:
        met = met.join(asked.select("qcid", F.col("v").alias("q")), "qcid")

        def near(batches):
            for b in batches:
                if len(b):
                    gap = np.stack(b["v"]) - np.stack(b["q"])
                    yield pd.DataFrame({"qcid": b["qcid"], "cid": b["cid"], "score": np.sqrt((gap**2).sum(1))})

    scored = met.select("qcid", "cid", "v", *(["q"] if "q" in met.columns else [])).mapInPandas(near, "qcid long, cid long, score double")
    best = Window.partitionBy("qcid").orderBy("score", "cid")
    return scored.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k).drop("rn")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score) for each query row: the k nearest other rows found, score the Euclidean distance.

    Vectors that are null, zero, or hold null or non-finite components take no part, neither do null keys and vectors
    of another length than the most common one.  Keys may be of any kind that has an order.  With fewer than k other rows all are returned.  Ties go to the smaller
    key.  Rows repeated with the same key and vector count once.  Extra columns play no part.
    """
    spark = vectors.sparkSession
    if not is_integral(vectors, key):  # keys of other kinds are numbered in their order meanwhile
        numbers = numbers_of(vectors, key)
        numbered = vectors.withColumn("_asks", is_query).join(numbers, key).select("_number", F.col(vector).alias("_vector"), "_asks")
        found = nearest(numbered, F.col("_asks"), k, "_number", "_vector")
        asked = numbers.select(F.col(key).alias("_query"), F.col("_number").alias("query_id"))
        return found.join(numbers, "_number").join(asked, "query_id").select(F.col("_query").alias("query_id"), "rank", key, "score")
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks")).where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").head(1)
    size = sizes[0]["size"] if sizes else 0
    rows = rows.where(F.size("v") == size)
    rows = rows.withColumn("h", F.xxhash64("v"))

    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    some = rows.select("h", "v", "id").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    classes = cut(some.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("cid", F.element_at("ids", 1)), "classes")
    n = classes.count()
    if not n:
        return spark.createDataFrame([], f"query_id long, rank int, `{key}` long, score double")
    asking = cut(rows.where("asks").select("id", "h", "v").distinct().join(classes.select("h", "v", "cid"), ["h", "v"]).select(F.col("id").alias("query_id"), "cid"), "queries")
    index = classes.select("cid", "v")
    asked = cut(index.join(asking.select("cid").distinct(), "cid", "left_semi").withColumnRenamed("cid", "qcid"), "asked")

    met = cut(ranked(candidates(index, asked, n), index, asked, k + 1), "met")
    few = met.groupBy("qcid").agg(F.count(F.lit(1)).alias("found")).where(F.col("found") < min(k + 1, n))
    few = asked.join(met.select("qcid").distinct(), "qcid", "left_anti").unionByName(asked.join(few.select("qcid"), "qcid", "left_semi"))
    few = cut(few, "few")
    if not few.isEmpty():
        again = ranked(candidates(index, few, n, whole=True), index, few, k + 1)
        met = met.join(few.select("qcid"), "qcid", "left_anti").unionByName(again)
    wide = met.join(classes.select("cid", "ids"), "cid").select("qcid", "score", F.explode("ids").alias("id"))
    wide = wide.withColumn("rn", F.row_number().over(Window.partitionBy("qcid").orderBy("score", "id"))).where(F.col("rn") <= k + 1)
    pairs = asking.join(wide.drop("rn"), F.col("cid") == F.col("qcid")).where("id <> query_id")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))).where(F.col("rank") <= k)
    return pairs.select("query_id", "rank", F.col("id").alias(key), "score")


def op9_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of embeddings for every row whose vec_id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, F.col("vec_id") % 100 == 0)


QUERIES = {"op9_permutation_index": op9_permutation_index}
ORACLE: dict[str, str] = {}
