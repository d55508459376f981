"""The stages that need a single record only, over streams.

Classification, markup, readings and row rules are columns and maps, so they run on a streaming DataFrame as they are; the
first row of each signature is kept by Spark's own stateful duplicate removal.  Alias resolution and bank numbers need
the whole input and have no streaming form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from glyphmill.functions import markup
from glyphmill.operators import emit
from glyphmill.operators.classify import classify
from glyphmill.operators.validate import row_errors


def canonical_terms(records: DataFrame, edition: str = "full") -> DataFrame:
    """Term rows, with their signatures, of the canonical records in a stream of (ordinal, headword, raw)."""
    canonical = classify(records).where("kind = 'canonical'").select("id", "headword", "raw")
    terms = emit.canonical_terms(emit.entries(markup.parsed(canonical, edition)))
    return terms.withColumn("signature", emit.signature(terms["glossary"]))


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Errors (scope, place, rule) of a stream of term rows (bank, place, row: JSON text)."""
    return row_errors(rows)


def first_seen(rows: DataFrame, signature: str = "signature", watermark: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows whose signature wasn't seen before; with a watermark column, signatures are forgotten after `delay`."""
    if watermark:
        return rows.withWatermark(watermark, delay).dropDuplicatesWithinWatermark([signature])
    return rows.dropDuplicates([signature])
