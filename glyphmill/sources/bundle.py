"""The bundle: term banks, index, stylesheet and media in one archive that depends on its content only.

Banks are made and deflated by the executors, one string each; the archive is put together out of finished streams (see
sources.archive).
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.sources import archive, files

TERM_COLUMNS = ("expression", "reading", "definition_tags", "rules", "score", "glossary", "sequence", "term_tags")


def row_json(rows: DataFrame) -> DataFrame:
    """rows with row: the eight slots as a compact JSON array; the glossary is JSON already."""
    q = lambda c: F.to_json(F.array(F.col(c)))  # noqa: E731  a one-element array quotes and escapes a string
    inner = lambda c: F.substring(q(c), F.lit(2), F.length(q(c)) - 2)
    slots = [inner("expression"), inner("reading"), inner("definition_tags"), inner("rules"), F.col("score").cast("string"), F.col("glossary"), F.col("sequence").cast("string"), inner("term_tags")]
    return rows.withColumn("row", F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]")))


def banks(rows: DataFrame, bank: str = "bank_no", order: str = "place") -> DataFrame:
    """(bank_no, content): one JSON array a bank, a row a line.  Banks are bounded, so each is one value."""
    listed = row_json(rows).groupBy(F.col(bank).alias("bank_no")).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "row"))).alias("rows"))
    lines = F.array_join(F.transform("rows", lambda x: x["row"]), ",\n")
    return listed.select("bank_no", F.concat(F.lit("[\n"), lines, F.lit("\n]\n")).alias("content"))


def index(title: str, revision: str, urls: tuple[str, str] | None = None, **more: Any) -> dict[str, Any]:
    out = {"title": title, "revision": revision, "format": 3, "sequenced": True, "isUpdatable": urls is not None, **more}
    return out | ({"indexUrl": urls[0], "downloadUrl": urls[1]} if urls else {})


def pretty(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n"


def write_zip(path: str, members: list[tuple[str, bytes]], more: DataFrame) -> str:
    """Write members and the rows (name, content) of more, by name, with fixed times and modes; SHA-256 of the file.  Tasks
    deflate the rows of more, which are computed once."""
    few = more.sparkSession.createDataFrame(members, "name string, content binary")
    archive.write(few.coalesce(1).union(more.select("name", F.col("content").cast("binary").alias("content"))), path)
    return files.digest(path)[1]


def write_bundle(path: str, rows: DataFrame, index_: dict[str, Any], css: str, media: DataFrame | None = None) -> str:
    """Write a whole bundle; rows have the term columns, bank_no and place; media has name and content."""
    named = banks(rows).select(F.concat(F.lit("term_bank_"), F.col("bank_no"), F.lit(".json")).alias("name"), F.encode("content", "utf-8").alias("content"))
    if media is not None:
        named = named.union(media.select("name", "content"))
    return write_zip(path, [("index.json", pretty(index_).encode()), ("styles.css", css.encode())], named)
