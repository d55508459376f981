"""What kind each raw record is, and the corrections that apply to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import text as T

#: Rules are few by nature; more than this many aren't broadcast.
BROADCAST_RULES = 10_000


def redirect_target(raw: Column) -> Column:
    """Target of a redirect record, normalized; null where raw isn't one.  An empty target still is."""
    bare = T.drop_nul(raw)
    pattern = r"(?sU)^\s*@@@LINK=(.*?)\s*$"
    # Few records have the mark at all, so the expression is seldom tried.
    return F.when(raw.contains("@@@LINK=") & bare.rlike(pattern), T.normalize_text(F.regexp_extract(bare, pattern, 1)))


def is_navigation(headword: Column, raw: Column) -> Column:
    low = F.lower(raw)
    marked = headword.startswith("x") | raw.rlike('(?i)class="entry-id"')
    return marked & ~low.contains("<hdcs") & low.contains("<ul")


def classify(records: DataFrame) -> DataFrame:
    """(id, headword, raw, redirect, exclusion, kind) from (ordinal, headword, raw): one pass, no shuffle.

    kind is canonical, redirect, or excluded; only canonical rows keep their raw.
    """
    target = redirect_target(F.col("raw"))
    rows = records.select(F.col("ordinal").alias("id"), "headword", T.drop_nul(F.col("raw")).alias("raw"), target.alias("redirect"))
    both_x = F.col("headword").startswith("x") & F.col("redirect").startswith("x")
    exclusion = F.when(F.col("redirect").isNotNull() & both_x, "navigation_redirect").when(F.col("redirect").isNull() & is_navigation(F.col("headword"), F.col("raw")), "navigation")
    rows = rows.withColumn("exclusion", exclusion)
    kind = F.when(F.col("exclusion").isNotNull(), "excluded").when(F.col("redirect").isNotNull(), "redirect").otherwise("canonical")
    rows = rows.withColumn("kind", kind)
    return rows.withColumn("raw", F.when(F.col("kind") == "canonical", F.col("raw")))


def correct(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows (id, headword, raw, …) with the matching rules (source_sha256, headword, before, after, rule) applied in the
    order of rule, and corrections: how many.  The query fails where `before` doesn't occur exactly once."""
    listed = rules.groupBy("source_sha256", F.col("headword").alias("_headword")).agg(F.sort_array(F.collect_list(F.struct("rule", "before", "after"))).alias("_rules"))
    few = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    rows = rows.withColumn("_sha", F.sha2("raw", 256))
    met = rows.join(F.broadcast(listed) if few else listed, (F.col("_sha") == F.col("source_sha256")) & (F.col("headword") == F.col("_headword")), "left")

    def apply(text: Column, rule: Column) -> Column:
        n = T.count_literal(text, rule["before"])
        wrong = F.raise_error(F.concat(F.lit("correction must match exactly once: "), rule["before"])).cast("string")
        return F.when(n == 1, T.replace_first(text, rule["before"], rule["after"])).otherwise(wrong)

    fixed = F.when(F.col("_rules").isNotNull(), F.aggregate("_rules", F.col("raw"), apply)).otherwise(F.col("raw"))
    met = met.withColumn("raw", fixed).withColumn("corrections", F.coalesce(F.size("_rules"), F.lit(0)).cast("long"))
    return met.drop("_sha", "_rules", "_headword", "source_sha256")
