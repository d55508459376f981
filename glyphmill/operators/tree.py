"""Markup trees as tables: a row for each element and each stretch of text, numbered so that trees can be searched by
columns alone.

`pre` counts rows in document order, `post` the order in which they end.  A row is inside another of its record if it
begins after it and ends before it: pre is larger and post is smaller.  Rows that begin later and end later are beside
it.  So whether something stands in something else is told by a running maximum of post over the rows in document order,
and what holds it, where no two candidates hold each other, by the last candidate before it: one shuffle by record and one
sort, whatever is asked, and work in proportion to the rows, never pairs of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.functions.markup import Malformed, Node, bare_text, tree

#: What tree_rows() tells of a row: parent is the pre of the element around it, place counts its siblings before it.
COLUMNS = "pre int, post int, parent int, depth int, place int, tag string, attrs map<string,string>, text string"


def tree_rows(raw: str, whole_references: bool = False) -> list[tuple]:
    """COLUMNS of the tree of a text; the first row is the tree itself, with an empty tag.  Text that can't be read as
    markup is a tree of its bare text."""
    try:
        top = tree(raw, whole_references)
    except Malformed:
        top = Node("", children=[bare_text(raw)])
    out: list[list] = []
    work: list[tuple] = [(top, None, 0, 0)]
    ended = 0
    while work:
        node, parent, depth, place = work.pop()
        if node is None:  # all inside row `parent` has ended
            out[parent][1] = ended
            ended += 1
        elif isinstance(node, str):
            out.append([len(out), ended, parent, depth, place, None, None, node])
            ended += 1
        else:
            pre = len(out)
            out.append([pre, -1, parent, depth, place, node.tag, node.attrs, None])
            work.append((None, pre, 0, 0))
            work += [(c, pre, depth + 1, k) for k, c in reversed(list(enumerate(node.children)))]
    return out


def node_table(records: DataFrame, key: str = "ordinal", raw: str = "raw", whole_references: bool = False) -> DataFrame:
    """(key, pre, post, parent, depth, place, tag, attrs, text) of the trees of records: elements have a tag and attributes
    (the harmless ones; elements that are active have no row, nor has what is in them), text has text.

    A null raw has no rows, an empty one its tree's own.  Rows of records that repeat a key are told apart by nothing: give
    each a key of its own.  Depth is bounded by memory only.  With whole_references a name is a character reference only
    with its semicolon, and a cut one (`&amp` before a tag) is text.
    """
    kind = records.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    if key in names:
        raise ValueError(f"the key is named like a column of the table: {key}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, text in zip(b[key], b[raw], strict=True):
                if isinstance(text, str):
                    rows = pd.DataFrame(tree_rows(text, whole_references), columns=names)
                    rows["parent"] = rows["parent"].astype("Int32")
                    yield pd.DataFrame({key: [k] * len(rows)}).join(rows)

    return records.select(key, raw).mapInPandas(run, f"`{key}` {kind}, {COLUMNS}")


def _ordered(*by: str):
    return Window.partitionBy(*by).orderBy("pre")


def _before(*by: str):
    return _ordered(*by).rowsBetween(Window.unboundedPreceding, -1)


def outermost(nodes: DataFrame, chosen: Column, key: str = "ordinal") -> DataFrame:
    """The chosen rows that stand in no other chosen one."""
    cover = F.max(F.when(chosen, F.col("post"))).over(_before(key))
    return nodes.withColumn("_cover", cover).where(chosen & (F.col("_cover").isNull() | (F.col("_cover") < F.col("post")))).drop("_cover")


def marked(nodes: DataFrame, chosen: Column, key: str = "ordinal") -> DataFrame:
    """nodes with `top`: the pre of the outermost chosen row that holds a row or is it, null outside of all."""
    cover = F.max(F.when(chosen, F.col("post"))).over(_before(key))
    held = F.coalesce(F.col("_cover") > F.col("post"), F.lit(False))
    wide = nodes.withColumn("_cover", cover).withColumn("_start", F.when(chosen & ~held, F.col("pre")))
    last = F.last("_start", ignorenulls=True).over(_ordered(key).rowsBetween(Window.unboundedPreceding, 0))
    return wide.withColumn("top", F.when(held | F.col("_start").isNotNull(), last)).drop("_cover", "_start")


def children(nodes: DataFrame, of: Column, key: str = "ordinal") -> DataFrame:
    """The rows right below the rows picked by `of`."""
    parents = nodes.where(of).select(key, F.col("pre").alias("parent"))
    return nodes.join(parents, [key, "parent"], "left_semi")


def first_inside(nodes: DataFrame, chosen: Column, of: Column, key: str = "ordinal") -> DataFrame:
    """The first chosen row inside each outermost row picked by `of`, with `top`: that row's pre."""
    inside = marked(nodes, of, key).where(F.col("top").isNotNull() & (F.col("top") != F.col("pre")))
    first = inside.where(chosen).withColumn("_n", F.row_number().over(_ordered(key, "top")))
    return first.where("_n = 1").drop("_n")


def texts(nodes: DataFrame, of: Column, skip: tuple[str, ...] = (), key: str = "ordinal") -> DataFrame:
    """(key, top, text): all text inside each outermost row picked by `of`, in order, without what stands in elements named
    in skip; such a row itself isn't skipped.  An element without text has an empty one."""
    inside = marked(nodes, of, key).where(F.col("top").isNotNull())
    if skip:
        out = F.coalesce(F.col("tag").isin(*skip), F.lit(False)) & (F.col("top") != F.col("pre"))
        cover = F.max(F.when(out, F.col("post"))).over(_before(key, "top"))
        inside = inside.withColumn("_out", F.coalesce(cover > F.col("post"), F.lit(False))).where(~F.col("_out")).drop("_out")
    said = F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("pre", "text"))))
    return inside.groupBy(key, "top").agg(F.array_join(F.transform(said, lambda x: x["text"]), "").alias("text"))


def private_use(nodes: DataFrame, key: str = "ordinal") -> DataFrame:
    """(key, found): whether a record's text, wherever it stands, holds a character for private use."""
    return nodes.groupBy(key).agg(F.coalesce(F.bool_or(F.col("text").rlike(r"\p{Co}")), F.lit(False)).alias("found"))


def tag_counts(nodes: DataFrame) -> DataFrame:
    """(tag, n) of all elements."""
    return nodes.where("tag <> ''").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
