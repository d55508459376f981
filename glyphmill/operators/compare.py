"""Comparison of tables of rows: multisets, corrections, conflicts; and of two bundles of the same records, before and
after readings were cleaned up.

What the readings should have become is derived anew from the raw records here, by expressions over their text that share
nothing with the engine's own pronunciation columns, so a fault in those shows up as a difference.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import nodes
from glyphmill.functions import text as T
from glyphmill.plans.scratch import cut
from glyphmill.sources.records import read_banks, read_members


def multiset_difference(expected: DataFrame, actual: DataFrame, columns: list[str]) -> DataFrame:
    """(columns…, missing, extra): rows whose multiplicities differ.  One shuffle of counts instead of two differences."""
    a = expected.select(*columns, F.lit(1).alias("_n"))
    b = actual.select(*columns, F.lit(-1).alias("_n"))
    sums = a.unionByName(b).groupBy(*columns).agg(F.sum("_n").alias("_d")).where("_d <> 0")
    return sums.select(*columns, F.greatest("_d", F.lit(0)).alias("missing"), F.greatest(-F.col("_d"), F.lit(0)).alias("extra"))


def conflicts(pairs: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys that map to more than one value."""
    return pairs.groupBy(*key).agg(F.count_distinct(value).alias("values")).where(F.col("values") > 1)


def expected_rows(old: DataFrame, changes: DataFrame) -> DataFrame:
    """old (sequence, reading, …) with the readings that changes (sequence, reading, readings, metadata) prescribe; a row
    for each, unchanged where nothing is prescribed."""
    met = old.join(changes, ["sequence", "reading"], "left")
    readings = F.coalesce("readings", F.array("reading"))
    changed = F.col("readings").isNotNull()
    return met.withColumn("changed", changed).withColumn("reading", F.explode(readings)).drop("readings")


def by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """(name, state) of members (name, content): only_left, only_right, different, or equal."""
    a, b = left.select("name", F.sha2("content", 256).alias("l")), right.select("name", F.sha2("content", 256).alias("r"))
    met = a.join(b, "name", "full_outer")
    state = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(F.col("l") != F.col("r"), "different").otherwise("equal")
    return met.select("name", state.alias("state"))


def same_index(a: dict, b: dict) -> bool:
    """Indexes are equal but for the revision."""
    return {**a, "revision": ""} == {**b, "revision": ""}


def edition_parity(full: DataFrame, light: DataFrame) -> DataFrame:
    """Lookup rows that the two editions don't have alike; empty means parity."""
    columns = ["expression", "reading", "definition_tags", "rules", "score", "sequence", "term_tags"]
    return multiset_difference(full, light, columns)


#: A pronunciation in a record's text; what it's made of.
PRON = r"(?s)<pron\b[^>]*>(.*?)</pron>"
TOKEN = r"(?s)<[^>]*>|[^<]+"
# What stands for a character in markup, and the words by which the source says that a reading is unknown.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))
UNKNOWN = "音未详"
#: Letters of the source by which the older bundles wrote others, and what they stand for.
OLDER = dict(list(zip(T.LOOKALIKES, T.PLAIN, strict=True))[:2])


def _shown(text: Column) -> Column:
    """Text as it is shown: what stands for characters replaced."""
    for was, now in ENTITIES:
        text = F.replace(text, F.lit(was), F.lit(now))
    return text


def _old(text: Column) -> Column:
    """A reading as the older bundles wrote it."""
    return T.strip(T.nfc(F.translate(text, "".join(OLDER), "".join(OLDER.values()))))


def pronunciation_parts(markup: Column) -> Column:
    """STRUCT<original, primary, notes> of a pronunciation's markup: all its text; its text without notes and the comma and
    white space before each; the text of each outermost note.

    One fold over tags and texts with the number of notes that are open, so notes may nest at will.  A note that isn't
    closed ends with the pronunciation, and an end without a beginning says nothing.
    """
    text = F.lit("").cast("string")
    # done: text up to the last note, for good; tail: text since then, which may end in a note's comma.
    start = F.struct(F.lit(0).alias("open"), text.alias("all"), text.alias("done"), text.alias("tail"), text.alias("note"), F.array().cast("array<string>").alias("notes"))

    def step(s: Column, token: Column) -> Column:
        said = F.when(token.startswith("<"), F.lit("")).otherwise(_shown(token))
        begins, ends = token.rlike(r"(?i)^<duyin\b"), token.rlike(r"(?i)^</duyin\b") & (s["open"] > 0)
        outside = s["open"] == 0
        first, last = begins & outside, ends & (s["open"] == 1)
        return F.struct(
            (s["open"] + F.when(begins, 1).when(ends, -1).otherwise(0)).alias("open"),
            F.concat(s["all"], said).alias("all"),
            F.when(first, F.concat(s["done"], F.regexp_replace(s["tail"], r"(?U)[,，]?\s*$", ""))).otherwise(s["done"]).alias("done"),
            F.when(first, F.lit("")).when(outside, F.concat(s["tail"], said)).otherwise(s["tail"]).alias("tail"),
            F.when(first, F.lit("")).when(~outside, F.concat(s["note"], said)).otherwise(s["note"]).alias("note"),
            F.when(last, F.concat(s["notes"], F.array(s["note"]))).otherwise(s["notes"]).alias("notes"),
        )

    def finish(s: Column) -> Column:
        notes = F.when(s["open"] > 0, F.concat(s["notes"], F.array(s["note"]))).otherwise(s["notes"])
        return F.struct(s["all"].alias("original"), F.concat(s["done"], s["tail"]).alias("primary"), notes.alias("notes"))

    return F.aggregate(F.regexp_extract_all(markup, F.lit(TOKEN), F.lit(0)), start, step, finish)


def expected_readings(records: DataFrame) -> DataFrame:
    """(sequence, reading, readings, kind, told): which readings the old reading of a record has become, and what has to
    be told about it: kind original (its text) or notes (theirs, joined), null for nothing.  From (ordinal, raw)."""
    found = records.where(F.col("raw").contains("<pron")).select(F.col("ordinal").alias("sequence"), F.explode(F.regexp_extract_all(T.drop_nul(F.col("raw")), F.lit(PRON), F.lit(1))).alias("m"))
    found = found.select("sequence", pronunciation_parts(F.col("m")).alias("p")).select("sequence", "p.original", F.transform("p.notes", lambda x: T.strip(T.nfc(x))).alias("notes"), T.strip(F.col("p.primary")).alias("primary"))
    # A pronunciation in brackets: what its first ones hold, up to the phonetic symbols.
    bracketed = F.left("primary", F.lit(1)).isin("［", "[")
    inside = F.regexp_extract("primary", r"(?s)^.([^］\]]*)", 1)
    value = F.when(bracketed, T.before_bopomofo(inside)).otherwise(F.col("primary"))
    found = found.withColumn("bracketed", bracketed).withColumn("value", value)
    clean = lambda x: T.strip(T.nfc(F.translate(_old(x), T.LOOKALIKES, T.PLAIN)))
    found = found.withColumn("each", F.transform(F.split("value", "/", -1), clean))
    unsure = lambda x: (x == "") | x.contains("?") | T.has_private_use(x) | x.contains(UNKNOWN)
    good = F.array_distinct(F.filter("each", lambda x: ~unsure(x)))
    unresolved = F.exists("each", unsure) & (T.strip(F.col("original")) != "")
    kind = F.when(F.col("bracketed") | unresolved, "original").when(F.size("notes") > 0, "notes")
    told = F.when(kind == "original", T.strip(T.nfc(F.col("original")))).when(kind == "notes", F.array_join("notes", "；"))
    return found.select("sequence", _old(F.col("original")).alias("reading"), F.when(F.size(good) > 0, good).otherwise(F.array(F.lit(""))).alias("readings"), kind.alias("kind"), told.alias("told"))


def told_apart(changes: DataFrame) -> DataFrame:
    """changes, each key once; the query fails where a key has become different things."""
    listed = changes.groupBy("sequence", "reading").agg(F.collect_set(F.struct("readings", "kind", "told")).alias("all"))
    wrong = F.raise_error(F.concat(F.lit("conflicting readings of record "), F.col("sequence").cast("string")))
    return listed.withColumn("one", F.when(F.size("all") > 1, wrong.cast("array<string>")).otherwise(F.array(F.lit("")))).where(F.size("one") == 1).select("sequence", "reading", F.explode("all").alias("x")).select("sequence", "reading", "x.*")


#: What no reading has after the clean-up: letters of the source, marks of alternatives, doubt and asides, phonetic symbols.
NOT_IN_READINGS = f"[{T.LOOKALIKES}/？?（）()" + r"［］\[\]" + f"{T.BOPOMOFO}]"
METADATA, HEADER = "reading-metadata", "header"
ROW = "sequence bigint, expression string, reading string, rest string, told array<string>"


def split_rows(banks: DataFrame) -> DataFrame:
    """(sequence, expression, reading, rest, told) of term rows (row: JSON text): rest is the canonical text of the row
    without its reading and without what is told about readings, which is in told."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text in b["row"]:
                row = json.loads(text)
                glossary, found = [], []
                for item in row[5]:
                    content, gone = nodes.without(item.get("content"), lambda n: nodes.kind(n) == METADATA, lambda n: nodes.kind(n) == HEADER) if isinstance(item, dict) else (None, [])
                    glossary.append({**item, "content": content} if isinstance(item, dict) and "content" in item else item)
                    found += map(nodes.text, gone)
                rest = json.dumps([row[0], "", *row[2:5], glossary, *row[6:]], ensure_ascii=False, sort_keys=True, separators=(",", ":"))
                out.append((row[6], row[0], row[1], rest, found))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ROW.split(", ")])

    return banks.select("row").mapInPandas(run, ROW)


def cleanup_differences(old: DataFrame, new: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Differences (problem, sequence, expression, reading) and counters (name, n) of split rows before and after, given
    what the readings should have become."""
    digest = F.sha2(F.concat_ws("\x00", "rest", "reading"), 256)
    expected = expected_rows(old.drop("told"), told_apart(changes).withColumnRenamed("kind", "kind_"))
    expected = expected.withColumn("signature", digest)
    once = expected.groupBy("signature").agg(*(F.min(c).alias(c) for c in ("sequence", "expression", "reading", "kind_", "told")))
    actual = new.withColumnRenamed("told", "found").withColumn("signature", digest)
    rows = actual.select("signature", F.col("sequence").alias("s"), F.col("expression").alias("e"), F.col("reading").alias("r"), "found")
    met = once.join(rows, "signature", "full_outer")
    said = F.element_at("found", 1)
    right = F.when(F.col("kind_") == "original", said.startswith(F.concat(F.lit("原文读音："), F.col("told")))).when(F.col("kind_") == "notes", said == F.concat(F.lit("读音附注："), F.col("told")))
    told = F.size("found") > 0
    problem = (
        F.when(F.col("s").isNull(), "missing_row").when(F.col("sequence").isNull(), "unexpected_row")
        .when(told != F.col("kind_").isNotNull(), "metadata_presence").when(told & (F.size("found") > 1), "metadata_repeated").when(told & ~right, "metadata_text")
        .when(F.col("r").rlike(NOT_IN_READINGS) | T.has_private_use(F.col("r")), "reading_not_clean")
    )
    columns = [F.coalesce(a, b).alias(a) for a, b in (("sequence", "s"), ("expression", "e"), ("reading", "r"))]
    different = met.withColumn("problem", problem).where("problem is not null").select("problem", *columns)
    repeated = actual.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in ("sequence", "expression", "reading"))).where("n > 1")
    different = different.unionByName(repeated.select(F.lit("repeated_row").alias("problem"), "sequence", "expression", "reading"))
    changed = old.join(told_apart(changes).select("sequence", "reading", "readings"), ["sequence", "reading"], "left")
    after = F.coalesce("readings", F.array("reading"))
    first = changed.agg(F.count(F.lit(1)).alias("old_rows"), F.count_if(after != F.array("reading")).alias("changed_original_rows"), F.count_if(F.size(after) > 1).alias("expanded_original_rows"), F.sum(F.size(after)).alias("fanned_rows"))
    second = new.agg(F.count(F.lit(1)).alias("new_rows"), F.count_if(F.size("told") > 0).alias("rows_with_retained_pronunciation"))
    third = once.agg(F.count(F.lit(1)).alias("expected_rows"))
    unpivoted = [d.select([F.col(c).cast("long").alias(c) for c in d.columns]).unpivot([], d.columns, "name", "n") for d in (first, second, third)]
    counts = unpivoted[0].union(unpivoted[1]).union(unpivoted[2])
    duplicates = counts.agg((F.sum(F.when(F.col("name") == "fanned_rows", F.col("n"))) - F.sum(F.when(F.col("name") == "expected_rows", F.col("n")))).alias("n"))
    return different, counts.where("name <> 'fanned_rows'").union(duplicates.select(F.lit("expected_exact_duplicates").alias("name"), "n"))


def compare_bundles(spark: SparkSession, old: str, new: str, records: DataFrame, most: int = 1000) -> dict:
    """Whether a bundle is an older one of the same records with its readings cleaned up, and nothing else."""
    members = [cut(read_members(spark, p), "members") for p in (old, new)]
    is_bank = F.col("name").rlike(r"^term_bank_\d+\.json$")
    assets = by_name(*(m.where(~is_bank & (F.col("name") != "index.json")) for m in members))
    indexes = [json.loads(bytes(m.where("name = 'index.json'").first()["content"])) for m in members]
    changes = cut(expected_readings(records), "changes")
    split = [cut(split_rows(read_banks(spark, p)), "rows") for p in (old, new)]
    different, counts = cleanup_differences(*split, changes)
    found = [r.asDict() for r in different.orderBy("problem", "sequence", "expression", "reading").limit(most).collect()]
    lost = [r.asDict() for r in assets.where("state <> 'equal'").orderBy("name").limit(most).collect()]
    same = same_index(*indexes)
    equal = assets.where("state = 'equal'").count()
    return {"passed": not found and not lost and same, "same_index": same, "assets": lost, "differences": found, "counts": {"unchanged_assets": equal, **{r["name"]: r["n"] for r in counts.orderBy("name").collect()}}}
