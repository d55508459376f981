"""Counters and samples of a run, computed from columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def counters(rows: DataFrame, **conditions: Column) -> DataFrame:
    """(name, n): how many rows meet each condition, in one pass."""
    one = rows.agg(*(F.count_if(c).alias(k) for k, c in conditions.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.col(k).alias("n")) for k in conditions))).alias("x")).select("x.name", "x.n")


def count_by(rows: DataFrame, key: str, empty: str | None = None) -> DataFrame:
    value = F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit(empty)) if empty else F.col(key)
    return rows.groupBy(value.alias(key)).agg(F.count(F.lit(1)).alias("n"))


def count_each(rows: DataFrame, array: str, name: str) -> DataFrame:
    """How many rows have each item of an array; an item counts once a row."""
    return rows.select(F.explode(F.array_distinct(array)).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def first_of_group(rows: DataFrame, key: list[str], order: list[str], most: int = 25) -> DataFrame:
    """The first `most` rows of each group; groups are cut down before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("place", place.cast("long")).where(F.col("place") <= most)


def first_distinct(rows: DataFrame, value: str, order: str, most: int = 100) -> DataFrame:
    """The first `most` distinct values by where they first occur."""
    return rows.groupBy(value).agg(F.min(order).alias("first")).orderBy("first", value).limit(most)


def events(parsed: DataFrame, column: str = "events") -> DataFrame:
    """Sums of the named counts that the markup function returns a record."""
    return parsed.select(F.explode(column).alias("x")).groupBy("x.name").agg(F.sum("x.n").alias("n"))


def bank_samples(banks: DataFrame, number: str = "bank_no") -> DataFrame:
    """The first, the middle and the last bank; banks are few."""
    rows = banks.select(number).distinct().withColumn("rn", F.row_number().over(Window.orderBy(number))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    return rows.where((F.col("rn") == 1) | (F.col("rn") == F.floor(F.col("n") / 2) + 1) | (F.col("rn") == F.col("n"))).select(number)
