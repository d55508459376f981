"""Alias resolution: which canonical rows a redirect leads to, over chains and through cycles, and in which order.

A redirect leads to all canonical rows of its target if there are any, and only otherwise on through the redirect rows
of that headword, in the order of their ids; what is reached twice counts where it is reached first, and a way that comes
back to where it has been ends there.  So the canonical rows of a target come in the order of the least way to their
headword - ways are compared as lists of the redirect rows they take, no headword twice - and of their ids.

Most headwords lead to one other only, and there a way has no choice.  Such chains are shortened first, by doubling: a
chain of n takes log n rounds over one table of pointers, and what goes round in circles is left when a round reaches
nothing new.  What is left is a graph of the few headwords with several redirects; their least ways are found by a frontier
that carries them, and a way that is not the least to its end is never carried on, since no least way goes through it.

Only ids, headwords and redirects are written and read by the rounds, whatever the sources carry.  There is no bound on
the length of chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.operators.skew import spread_join
from glyphmill.plans.scratch import cut, cut_and_counted

_WAY = "array<bigint>"


def _shortened(links: DataFrame) -> DataFrame:
    """(headword, end) of chains of links (headword, redirect): where they leave the links; circles have no end."""
    pointers, before = links.select("headword", F.col("redirect").alias("end")), -1
    while True:
        onward = pointers.select(F.col("headword").alias("end"), F.col("end").alias("next"))
        doubled = pointers.join(onward, "end", "left").select("headword", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("moved"))
        doubled, counts = cut_and_counted(doubled, "pointers", moved=F.count_if("moved"))
        pointers = doubled.select("headword", "end")
        if not counts["moved"]:
            return pointers
        if counts["moved"] == before:  # what hasn't ended in a round never does
            return doubled.where("not moved").select("headword", "end")
        before = counts["moved"]


def _least_ways(targets: DataFrame, forks: DataFrame) -> DataFrame:
    """(at, headword, way): the least way from each fork that a target leads to (at) to each headword it reaches over
    forks (headword, to, id), itself included."""
    starts = targets.join(forks.select(F.col("headword").alias("at")), "at", "left_semi").select("at").distinct()
    found = cut(starts.select("at", F.col("at").alias("headword"), F.expr(f"cast(array() as {_WAY})").alias("way"), F.array("at").alias("met")), "ways")
    frontier = found
    while True:
        onward = frontier.join(forks, "headword").where(~F.array_contains("met", F.col("to")))
        onward = onward.select("at", F.col("to").alias("headword"), F.struct(F.concat("way", F.array("id")).alias("way"), F.concat("met", F.array("to")).alias("met")).alias("new"))
        least = onward.groupBy("at", "headword").agg(F.min("new").alias("new"))
        before = found.select("at", "headword", F.col("way").alias("_old"))
        better = least.join(before, ["at", "headword"], "left").where("_old is null or new.way < _old").select("at", "headword", "new.way", "new.met")
        frontier, counts = cut_and_counted(better, "frontier", n=F.count(F.lit(1)))
        if not counts["n"]:
            return found.select("at", "headword", "way")
        found = cut(found.join(frontier, ["at", "headword"], "left_anti").unionByName(frontier), "ways")


def resolve(sources: DataFrame) -> DataFrame:
    """(target, way, canonical_id) for every target of a redirect, from (id, headword, redirect, exclusion); the rows of a
    target are in the order of way and canonical_id."""
    live = cut(sources.where(F.col("exclusion").isNull()).select("id", "headword", "redirect"), "live")
    canonical = live.where(F.col("redirect").isNull()).select("headword", F.col("id").alias("canonical_id"))
    redirects = live.where(F.col("redirect").isNotNull())
    steps = redirects.join(canonical.select("headword").distinct(), "headword", "left_anti").groupBy("headword", "redirect").agg(F.min("id").alias("id"))
    steps = cut(steps, "steps")
    several, counts = cut_and_counted(steps.groupBy("headword").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("headword"), "several", n=F.count(F.lit(1)))
    ends = _shortened(steps.join(several, "headword", "left_anti").select("headword", "redirect"))

    def at_end(rows: DataFrame, name: str) -> DataFrame:
        """rows with the headword in a column replaced by where its chain ends."""
        far = ends.select(F.col("headword").alias(name), F.col("end").alias("_end"))
        return rows.join(far, name, "left").withColumn(name, F.coalesce("_end", name)).drop("_end")

    targets = cut(at_end(redirects.select(F.col("redirect").alias("target")).distinct().withColumn("at", F.col("target")), "at"), "targets")
    reached = targets.select("target", F.col("at").alias("headword"), F.expr(f"cast(array() as {_WAY})").alias("way"))
    if counts["n"]:
        forks = at_end(steps.join(several, "headword").withColumnRenamed("redirect", "to"), "to")
        forks = cut(forks.groupBy("headword", "to").agg(F.min("id").alias("id")), "forks")
        reached = reached.unionByName(targets.join(_least_ways(targets, forks), "at").select("target", "headword", "way").where(F.size("way") > 0))
    return reached.join(canonical, "headword").select("target", "way", "canonical_id")


def _redirects(sources: DataFrame) -> DataFrame:
    return sources.where("exclusion is null and redirect is not null").select(F.col("id").alias("alias_id"), F.col("headword").alias("alias"), F.col("redirect").alias("target"))


def resolved_aliases(sources: DataFrame) -> DataFrame:
    """(alias_id, alias, canonical_id, place) for every redirect row that leads somewhere; place counts from 0."""
    order = F.sort_array(F.collect_list(F.struct("way", "canonical_id")))
    ids = resolve(sources).groupBy("target").agg(F.transform(order, lambda x: x["canonical_id"]).alias("ids"))
    found = spread_join(_redirects(sources), cut(ids, "targets"), "target")
    return found.select("alias_id", "alias", F.posexplode("ids").alias("place", "canonical_id")).select("alias_id", "alias", "canonical_id", F.col("place").cast("long").alias("place"))


def unresolved_aliases(sources: DataFrame) -> DataFrame:
    """(alias_id, alias, target) of the redirect rows that lead nowhere."""
    found = cut(resolve(sources).select("target").distinct(), "targets")
    return spread_join(_redirects(sources), found, "target", "left_anti").select("alias_id", "alias", "target")
