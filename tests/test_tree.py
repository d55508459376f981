import random

import pytest
from pyspark.sql import functions as F

from glyphmill.functions import markup
from glyphmill.operators import tree

POOL = ["<hm>", "</hm>", "<duyin>", "</duyin>", "<sup>", "</sup>", "<p>", "</p>", "<li>", "<br>", "a", " b ", "&amp;", "<script>x</script>", "</q>", "<!-- c -->", '<i class="k" title="t">', "</i>"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "ordinal long, raw string")


def plain(raw):
    """[(node, parents, ancestors' tags, preorder number)] of the tree itself."""
    out = []

    def walk(node, above):
        out.append((node, above))
        for c in node.children if isinstance(node, markup.Node) else ():
            walk(c, [*above, node])

    walk(markup.tree(raw), [])
    return out


def test_rows_tell_the_tree():
    for raw in random_texts(300, 1):
        rows, want = tree.tree_rows(raw), plain(raw)
        assert len(rows) == len(want)
        number = {id(node): pre for pre, (node, _) in enumerate(want) if isinstance(node, markup.Node)}
        for (pre, post, parent, depth, place, tag, attrs, text), (node, above) in zip(rows, want, strict=True):
            assert pre == rows.index([pre, post, parent, depth, place, tag, attrs, text]) and depth == len(above)
            assert parent == (number[id(above[-1])] if above else None)
            assert (tag, attrs, text) == ((node.tag, node.attrs, None) if isinstance(node, markup.Node) else (None, None, node))
            if above:
                assert above[-1].children[place] is node or above[-1].children[place] == node
            holding = {r[0] for r in rows if r[0] < pre and r[1] > post}
            assert holding == {number[id(a)] for a in above}


def test_deep_trees():
    rows = tree.tree_rows("<i>" * 20_000 + "x")
    assert rows[-1][3] == 20_001 and rows[0][1] == 20_001


def outer(rows, tag):
    return [(pre, node) for pre, (node, above) in enumerate(rows) if isinstance(node, markup.Node) and node.tag == tag and tag not in {a.tag for a in above}]


@pytest.mark.parametrize("tag", ["hm", "duyin", "sup"])
def test_searches_equal_the_tree(spark, tag):
    texts = random_texts(120, 2)
    nodes = tree.node_table(frame(spark, texts)).cache()
    chosen = F.col("tag") == tag
    got = {(r["ordinal"], r["pre"]) for r in tree.outermost(nodes, chosen).collect()}
    assert got == {(i, pre) for i, raw in enumerate(texts) for pre, _ in outer(plain(raw), tag)}
    for skip in ((), ("sup",), ("sup", "i")):
        said = {(r["ordinal"], r["top"]): r["text"] for r in tree.texts(nodes, chosen, skip).collect()}
        assert said == {(i, pre): node.text(skip) for i, raw in enumerate(texts) for pre, node in outer(plain(raw), tag)}
    firsts = {(r["ordinal"], r["top"], r["pre"]) for r in tree.first_inside(nodes, F.col("tag") == "li", chosen).collect()}
    want = set()
    for i, raw in enumerate(texts):
        rows = plain(raw)
        number = {id(n): pre for pre, (n, _) in enumerate(rows) if isinstance(n, markup.Node)}
        want |= {(i, pre, number[id(found)]) for pre, node in outer(rows, tag) if (found := node.first("li"))}
    assert firsts == want
    kids = {(r["ordinal"], r["pre"]) for r in tree.children(nodes, chosen).collect()}
    assert kids == {(i, pre) for i, raw in enumerate(texts) for pre, (_, above) in enumerate(plain(raw)) if above and above[-1].tag == tag}


def test_counts_and_private_use(spark):
    texts = ["<b>x</b><b></b>", "", "<i title=''>plain</i>"]
    nodes = tree.node_table(frame(spark, texts))
    assert {r["tag"]: r["n"] for r in tree.tag_counts(nodes).collect()} == {"b": 2, "i": 1}
    assert {r["ordinal"]: r["found"] for r in tree.private_use(nodes).collect()} == {0: True, 1: False, 2: False}


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, "x", 5), (2, "", "y", 6), (None, "t", "z", 7), (3, "<![x", "w", 8)], "ordinal long, raw string, tag string, pre int")
    got = [(r["ordinal"], r["pre"], r["tag"], r["text"]) for r in tree.node_table(rows).collect()]
    assert got == [(2, 0, "", None), (None, 0, "", None), (None, 1, None, "t"), (3, 0, "", None), (3, 1, None, "<![x")]
    empty = tree.node_table(rows.where("false"))
    assert empty.count() == 0 and tree.texts(empty, F.col("pre") == 0).count() == 0 and tree.outermost(empty, F.lit(True)).count() == 0


def test_names_without_a_tree():
    for raw in random_texts(2000, 3):
        assert markup.tag_names(raw) == [n.tag for n in markup.tree(raw).elements() if n.tag]


def test_cut_references_are_text_where_whole_ones_are_asked_for(spark):
    """A name without its semicolon, or one that nobody knows, is no reference; in attributes, raw text and names neither."""
    raw = '<h1>a&amp;&amp</h1><p title="x&copy=1&amp;y">&copy &copy; &notit; &#65; &am</p><a&lt>t</a&lt><xmp>&amp</xmp>'
    rows = tree.node_table(spark.createDataFrame([(1, raw)], "k long, raw string"), "k", whole_references=True).orderBy("pre").collect()
    assert [r["text"] for r in rows if r["text"] is not None] == ["a&&amp", "&copy \xa9 &notit; A &am", "t", "&amp"]
    assert [r["attrs"] for r in rows if r["tag"] == "p"] == [{"title": "x&copy=1&y"}] and [r["tag"] for r in rows if r["tag"]] == ["h1", "p", "a&lt", "xmp"]
    assert [r[7] for r in tree.tree_rows("<h1>a&amp;&amp</h1>") if r[7] is not None] == ["a&&"]
