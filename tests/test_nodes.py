import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import nodes
from glyphmill.operators import validate


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 5 else 6)
    if kind < 6:
        return [None, True, False, rng.randrange(-99, 99), rng.random() * 10 ** rng.randrange(-9, 9), rng.choice(["", "x", "a\"b\\c\n", "é漢𝒳", "\u2028"])][kind]
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b_1", "a b", "", "é", "x.y", "content"]): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def plain(v, path="$", name=None, depth=0):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(v), "number")
    yield (path, name, depth, kind, v if kind == "string" else None)
    if isinstance(v, dict):
        for k, x in v.items():
            yield from plain(x, path + nodes.member_path(k), k, depth + 1)
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from plain(x, f"{path}[{i}]", None, depth + 1)


@pytest.mark.parametrize("seed", range(3))
def test_rows_equal_the_parsed_value(seed):
    rng = random.Random(seed)
    for _ in range(400):
        v = value(rng)
        text = json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))
        rows = nodes.json_rows(f" {text}\n")
        assert [(r[6], r[5], r[3], r[7], r[8]) for r in rows] == list(plain(v))
        for pre, post, parent, depth, place, *_, literal in rows:
            holding = sorted(r[0] for r in rows if r[0] < pre and r[1] > post)
            assert len(holding) == depth and (holding[-1] if holding else None) == parent
            assert place == sum(r[2] == parent and r[0] < pre for r in rows)
            assert literal is None or json.loads(literal) in (True, False, None) or float(literal) == json.loads(literal)


@pytest.mark.parametrize("text", ["", " ", "[", "]", "[1,]", "[,1]", "{\"a\"}", "{\"a\":}", "{\"a\":1,}", "{a:1}", "[1 2]", "[1]]", "1 2", "01", "1.", "-", "+1", "tru", "nul", "\"a", "\"\x01\"", "\"\\x\"", "{]", "[}", "{\"a\":1]", "'a'", "NaN", "1e", "[1}", ":", "{,}", "{\"a\":1 \"b\":2}", "\"\\u12\""])
def test_what_is_not_json(text):
    with pytest.raises(ValueError):
        json.loads(text) if text != "NaN" else (_ for _ in ()).throw(ValueError)
    with pytest.raises(nodes.NotJson):
        nodes.json_rows(text)


def test_random_damage_is_told_as_the_parser_tells_it():
    rng = random.Random(8)
    for _ in range(4000):
        text = list(json.dumps(value(rng)))
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice('[]{}:,"1e-. \\atn')
        text = "".join(text)
        try:
            want = list(plain(json.loads(text, object_pairs_hook=lambda pairs: dict(pairs) if len(dict(pairs)) == len(pairs) else 1 / 0)))
        except ValueError:
            want = None
        except ZeroDivisionError:  # names that repeat have a row each
            nodes.json_rows(text)
            continue
        try:
            got = [(r[6], r[5], r[3], r[7], r[8]) for r in nodes.json_rows(text)]
        except nodes.NotJson:
            got = None
        assert got == want, text


def test_any_depth_in_one_job(spark):
    """500 levels are walked whole; the plan is one pass."""
    deep = "[" * 500 + "1" + "]" * 500
    rows = spark.createDataFrame([(1, deep), (3, None), (4, "[1"), (5, "{}")], "k long, t string")
    found = nodes.json_table(rows, "k", "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInPandas") == 1
    got = found.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"), F.max("kind").alias("kind")).collect()
    assert {r["k"]: (r["n"], r["depth"]) for r in got} == {1: (501, 500), 4: (1, 0), 5: (1, 0)}
    assert {r["k"]: r["kind"] for r in got} == {1: "number", 4: "fault", 5: "object"}
    assert nodes.walked(rows.where("k = 1"), "k", "t").where("path = '$" + "[0]" * 500 + "' and not nested").count() == 1
    assert nodes.json_table(rows.where("false"), "k", "t").count() == 0
    with pytest.raises(ValueError):
        nodes.json_table(rows.withColumnRenamed("k", "pre"), "pre", "t")


def test_node_texts(spark):
    tree = {"x": ["a", {"content": ["b", {"tag": "c", "content": "d", "data": {"content": "no"}}, [{"content": {"content": "e"}}], {"title": "f"}]}, "g"], "content": "h"}
    rows = spark.createDataFrame([(1, json.dumps(tree)), (2, "[]")], "k long, t string")
    got = nodes.node_texts(nodes.json_table(rows, "k", "t"), "k", F.col("path") == "$.x").collect()
    assert [(r["k"], r["text"]) for r in got] == [(1, nodes.text(tree["x"]))] and got[0]["text"] == "abdeg"


def test_nodes_are_handed_over_in_parts():
    """A worker holds the nodes of a part of a batch only, and has the same nodes of all."""
    row = json.dumps(["e", "ā", "", "", 0, [{"type": "structured-content", "content": {"tag": "span", "content": ["x" * 1000]}}], 1, ""], ensure_ascii=False)
    batch = pd.DataFrame({"bank": 1, "place": range(2000), "row": [row] * 2000, "shaped": True})
    frames = list(validate.node_frames(iter([batch])))
    assert len(frames) > 2 and max(map(len, frames)) < 10 * 1000
    assert [p for f in frames for p in f["place"]] == [p for p in range(2000) for _ in range(len(frames[0]) // frames[0]["place"].nunique())]
