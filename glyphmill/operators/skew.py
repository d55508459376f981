"""Joins whose one side has keys that very many rows share.

Which keys these are is told by a sketch of the most frequent items, bounded in memory and added up from partial ones.  The
rows of a hot key are dealt over slices by a hash of theirs, and what the other side has for it is copied to each slice: at
most TRACKED keys times SLICES copies, whatever the tables hold.  All other keys are joined as ever.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most hot keys; items that the sketch tracks; slices of a hot key; rows, and share of all rows, that make a key hot.
MOST, TRACKED, SLICES = 32, 1024, 64
LEAST_ROWS, SHARE = 10_000, 1 / 200


def hot_keys(rows: DataFrame, key: Column) -> list:
    """The keys that many of the rows have, most frequent first; nulls aside."""
    found = rows.select(key.alias("k")).where("k is not null").agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {MOST}, {TRACKED})").alias("top")).first()
    least = max(LEAST_ROWS, SHARE * found["n"])
    return [x["item"] for x in found["top"] or () if x["count"] >= least]


def spread_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """many joined with few on key (how: inner, left, left_semi or left_anti); hot keys of many are spread."""
    hot = hot_keys(many, F.col(key))
    if not hot:
        return many.join(few, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    slice_ = F.when(is_hot, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in many.columns)), F.lit(SLICES)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0)))
    dealt, copied = many.withColumn("_slice", slice_), few.withColumn("_slice", F.explode(copies))
    return dealt.join(copied, [key, "_slice"], how).drop("_slice")
