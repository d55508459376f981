import random

import pytest
from pyspark.sql import functions as F

from glyphmill.operators import aliases, skew

SOURCES = "id long, headword string, redirect string, exclusion string"


def plain(rows):
    """alias id -> canonical ids: a search in depth that ends a way where it has been, ids in the order they are met."""
    by = {}
    for i, h, r, x in sorted(rows):
        if x is None:
            by.setdefault(h, []).append((i, r))

    def ids(h, met):
        if h in met:
            return []
        mine = by.get(h, [])
        own = [i for i, r in mine if r is None]
        return own or [c for _, r in mine for c in ids(r, {*met, h})]

    return {i: list(dict.fromkeys(ids(r, set()))) for i, h, r, x in rows if r is not None and x is None}


def got(frame):
    out = {}
    for r in aliases.resolved_aliases(frame).orderBy("alias_id", "place").collect():
        out.setdefault(r["alias_id"], []).append(r["canonical_id"])
        assert r["place"] == len(out[r["alias_id"]]) - 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs_equal_a_search_in_depth(spark, seed):
    rng = random.Random(seed)
    n = 26
    names = [f"h{i}" for i in range(n)]
    rows = [(i, rng.choice(names), rng.choice([*names, *names, "gone"]) if rng.random() < 0.85 else None, None if rng.random() < 0.93 else "navigation") for i in rng.sample(range(200), 34)]
    want = plain(rows)
    frame = spark.createDataFrame(rows, SOURCES)
    assert got(frame) == {i: ids for i, ids in want.items() if ids}
    assert {r["alias_id"] for r in aliases.unresolved_aliases(frame).collect()} == {i for i, ids in want.items() if not ids}


def test_order_is_that_of_the_way(spark):
    rows = [(1, "t", "b", None), (2, "t", "a", None), (3, "b", "z", None), (4, "b", "t", None), (9, "a", None, None), (8, "z", None, None), (7, "z", None, None), (5, "x", "t", None)]
    assert got(spark.createDataFrame(rows, SOURCES))[5] == [7, 8, 9] == plain(rows)[5]


@pytest.mark.parametrize("order", ["tail first", "head first", "mixed"])
def test_a_chain_of_a_thousand(spark, order):
    """Every name of the chain leads to its end, in a number of rounds that grows with the logarithm."""
    n = 1000
    ids = list(range(n)) if order == "tail first" else list(range(n, 0, -1)) if order == "head first" else random.Random(1).sample(range(n), n)
    rows = [(ids[i], f"h{i}", f"h{i - 1}" if i else None, None) for i in range(n)] + [(5000, "circle", "round", None), (5001, "round", "circle", None), (5002, "in", "circle", None)]
    found = aliases.resolved_aliases(spark.createDataFrame(rows, SOURCES))
    assert {(r["alias"], r["canonical_id"]) for r in found.collect()} == {(f"h{i}", ids[0]) for i in range(1, n)}


def test_empty(spark):
    none = spark.createDataFrame([], SOURCES)
    assert aliases.resolved_aliases(none).count() == 0 and aliases.unresolved_aliases(none).count() == 0


def sizes(df):
    """Rows of each task of a join that has any."""
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_third_of_all_aliases_on_one_target(spark, monkeypatch):
    """No task has over three times the median's rows, and the result is that of a plain join."""
    monkeypatch.setattr(skew, "LEAST_ROWS", 100)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5000)).alias("target")).union(spark.createDataFrame([(-1, None)], "id long, target string"))
        few = spark.range(4000).select(F.concat(F.lit("t"), "id").alias("target"), F.col("id").alias("x")).union(spark.createDataFrame([("hot", -5), ("hot", -6)], "target string, x long"))
        assert skew.hot_keys(many, F.col("target")) == ["hot"] and skew.hot_keys(few, F.col("target")) == []
        for how in ("inner", "left", "left_semi", "left_anti"):
            spread, plain_ = skew.spread_join(many, few, "target", how), many.join(few, "target", how)
            assert spread.columns == plain_.columns
            assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain_.collect()), key=str)
        rows = sizes(skew.spread_join(many, few, "target", "left_semi"))
        assert rows[-1] <= 3 * rows[len(rows) // 2] and sizes(many.join(few, "target", "left_semi"))[-1] > 5 * rows[len(rows) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
