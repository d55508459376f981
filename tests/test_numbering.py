from pyspark.sql import functions as F

from glyphmill.operators import emit
from glyphmill.plans import build


def test_a_range_stage_that_is_run_again_gives_the_same_places(spark):
    """Ties in the whole order are told by a digest, so two runs of the same plan agree row by row."""
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(5, "text")
    first, second = ({r["text"]: r["place"] for r in emit.global_row_number(rows, ("k",)).collect()} for _ in range(2))
    assert first == second and sorted(first.values()) == list(range(1, 5001))
    other = {r["text"]: r["place"] for r in emit.global_row_number(rows.repartition(11).orderBy(F.rand(3)), ("k",)).collect()}
    assert other == first


def test_equal_rows_are_spread(spark):
    rows = spark.range(0, 4000, 1, 8).select(F.lit("a").alias("k"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("x"))
    got = emit.global_row_number(rows, ("k",))
    assert sorted(r["place"] for r in got.collect()) == list(range(1, 4001)) and got.where("x = 'hot'").count() == 2000


def test_variants_are_rows_too(spark):
    rows = spark.createDataFrame([(1, '{"b":1}'), (1, '{"a":2}'), (0, None)], "k int, t string").select("k", F.parse_json("t").alias("v"))
    assert sorted(r["place"] for r in emit.global_row_number(rows, ("k",)).collect()) == [1, 2, 3]


def test_first_and_counts(spark):
    rows = spark.createDataFrame([("a", 2, "x", True), ("a", 1, "y", False), ("a", 1, "z", True), ("b", 5, None, False)], "k string, o int, v string, f boolean")
    got = sorted(tuple(r) for r in emit.first_and_counts(rows, "k", ("o",), n=F.count(F.lit(1)), t=F.count_if("f")).collect())
    assert got == [("a", 1, "y", False, 3, 2), ("b", 5, None, False, 1, 0)]


def test_statistics_need_no_second_pass(spark):
    """What was counted while tables were written isn't counted again: found and terms aren't read."""
    records = [(1, "a", "<hdc><hm><hw>a</hw><simp>b</simp><pron>gā/?</pron></hm><item>x</item></hdc>"), (2, "c", "@@@LINK=a"), (3, "d", "@@@LINK=no")]
    run = build.build(spark.createDataFrame(records, "ordinal long, headword string, raw string"))
    plan = build.statistics(run)._jdf.queryExecution().executedPlan().toString()
    assert "found-" not in plan and "terms-" not in plan and "aliases-" not in plan and "sources-" not in plan
    counts = {r["name"]: r["n"] for r in build.statistics(run).collect()}
    assert counts == {"input_records": 3, "redirect_records": 2, "canonical_records": 1, "source_pronunciation_blocks": 1, "slash_alternatives": 1, "unresolved_question_mark": 1, "generated_source_variants": 1, "resolved_redirects": 1, "unresolved_redirects": 1, "emitted_terms": 3}
