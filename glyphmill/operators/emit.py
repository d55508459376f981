"""Term rows: glossaries, variants, redirects, duplicates, banks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from glyphmill.functions import readings as R
from glyphmill.functions import text as T
from glyphmill.operators.aliases import resolved_aliases
from glyphmill.operators.skew import spread_join
from glyphmill.plans.scratch import cut
from glyphmill.sources.bundle import TERM_COLUMNS

BANK_ROWS = 10_000
ORDER = ("phase", "a", "b", "c")


def _json(c: Column) -> Column:
    """A string as a JSON string."""
    quoted = F.to_json(F.array(c))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def _items(c: Column) -> Column:
    """The inside of a JSON array's text; null where it's empty."""
    return F.nullif(F.substring(c, F.lit(2), F.length(c) - 2), F.lit(""))


def _box(kind: str, items: Column, tag: str = "div", more: str = "") -> Column:
    return F.concat(F.lit(f'{{"tag":"{tag}","content":['), items, F.lit(f'],"data":{{"content":"{kind}"}}{more}}}'))


def glossary(e: Column, r: Column, root: str = "record-entry", lang: str = "zh-Hans") -> Column:
    """The glossary of an entry e (of functions.markup) with its readings r (of functions.readings), as JSON text."""
    open_ = F.when(F.size(r["unresolved"]) > 0, _json(F.concat(F.lit("（未解析字符："), F.array_join(r["unresolved"], ", "), F.lit("）"))))
    source = F.concat_ws(",", _json(F.lit("原文读音：")), _items(e["pron_json"]), open_)
    notes = F.concat(_json(F.lit("读音附注：")), F.lit(","), F.array_join(e["notes_json"], ',"；",'))
    said = F.when(r["retain_source"] & e["has_pron"], source).when(F.size(e["notes_json"]) > 0, notes)
    header = F.nullif(F.concat_ws(",", _items(e["header_json"]), _box("reading-metadata", said)), F.lit(""))
    content = F.concat_ws(",", e["row_json"], _box("header", header), _items(e["body_json"]))
    shown = F.concat(F.lit('[{"type":"structured-content","content":'), _box(root, content, "span", f',"lang":"{lang}"'), F.lit("}]"))
    # Of malformed markup only the text is left.
    text = F.concat(F.lit('[{"type":"text","text":'), F.coalesce(_items(e["body_json"]), F.lit('""')), F.lit("}]"))
    return F.when(e["plain"], text).otherwise(shown)


def entries(parsed: DataFrame, root: str = "record-entry") -> DataFrame:
    """(source_id, block, entry_index, reading, expression, alternates, glossary, reasons, …): a row for each definition
    block and reading, from parsed canonical rows (id, entries)."""
    rows = parsed.select(F.col("id").alias("source_id"), F.posexplode("entries").alias("block", "e"))
    r = R.reading(F.col("e.primary"), F.col("e.original"), F.size("e.notes_json") > 0)
    default = F.struct(F.array(F.lit("")).alias("readings"), F.lit(False).alias("retain_source"), F.expr("cast(array() as array<string>)").alias("reasons"), F.expr("cast(array() as array<string>)").alias("unresolved"))
    rows = rows.withColumn("r", F.when(F.col("e.has_pron"), r).otherwise(default)).withColumn("glossary", glossary(F.col("e"), F.col("r"), root))
    rows = rows.select("source_id", "block", "e.expression", "e.alternates", "e.omitted_content_id", "e.has_pron", "e.generic", "e.plain", "e.private_use", "e.original", "glossary", F.col("r.reasons").alias("reasons"), F.col("r.readings").alias("readings"), F.posexplode("r.readings").alias("reading_no", "reading"))
    # Order within a record: by block, then reading; both are array places, so neither reaches 2**31.
    return rows.withColumn("entry_index", F.col("block").cast("long") * (1 << 31) + F.col("reading_no"))


def _term(expression: Column, reading: Column, sequence: Column, tag: str) -> list[Column]:
    return [
        T.nfc(expression).alias("expression"), T.nfc(reading).alias("reading"), F.lit("").alias("definition_tags"), F.lit("").alias("rules"), F.lit(0).alias("score"),
        F.col("glossary"), sequence.cast("long").alias("sequence"), F.lit(tag).alias("term_tags"), F.col("omitted_content_id"),
    ]


def canonical_terms(found: DataFrame) -> DataFrame:
    return found.select(F.lit(0).alias("phase"), F.col("source_id").alias("a"), F.col("entry_index").alias("b"), F.lit(0).cast("long").alias("c"), *_term(F.col("expression"), F.col("reading"), F.col("source_id"), ""))


def suppressed(alternates: DataFrame, sources: DataFrame, name: str = "alternate") -> DataFrame:
    """The alternates that no source row of any kind has as its headword."""
    heads = sources.select(F.col("headword").alias(name)).distinct()
    return spread_join(alternates, heads, name, "left_anti")


def variant_terms(found: DataFrame, sources: DataFrame) -> DataFrame:
    wide = found.select("*", F.posexplode("alternates").alias("alternate_index", "alternate"))
    kept = suppressed(wide, sources)
    return kept.select(F.lit(0).alias("phase"), F.col("source_id").alias("a"), F.col("entry_index").alias("b"), (F.col("alternate_index") + 1).cast("long").alias("c"), *_term(F.col("alternate"), F.col("reading"), F.col("source_id"), "variant"))


def redirect_terms(found: DataFrame, aliases: DataFrame) -> DataFrame:
    """The canonical entries of what an alias (of resolved_aliases()) leads to, under the alias."""
    met = spread_join(aliases.withColumnRenamed("canonical_id", "source_id"), found, "source_id").withColumnRenamed("source_id", "canonical_id")
    return met.select(F.lit(1).alias("phase"), F.col("alias_id").alias("a"), F.col("place").alias("b"), F.col("entry_index").alias("c"), *_term(F.col("alias"), F.col("reading"), F.col("canonical_id"), "redirect"))


def signature(glossary_json: Column) -> Column:
    """SHA-256 of a term row in canonical form, with what the light edition left out.  A glossary that isn't JSON counts as
    its text."""
    slots = [*(_json(F.col(c)) for c in ("expression", "reading", "definition_tags", "rules")), F.col("score").cast("string"), F.coalesce(T.canonical_json(glossary_json), _json(glossary_json), F.lit("null")), F.col("sequence").cast("string"), _json(F.col("term_tags"))]
    plain = F.sha2(F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]")), 256)
    return F.when(F.col("omitted_content_id") != "", F.sha2(F.concat(F.unhex(plain), F.encode("omitted_content_id", "utf-8")), 256)).otherwise(plain)


def first_of_each(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of each key; candidates are cut down to one a key before the shuffle."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def first_and_counts(rows: DataFrame, key: str, order: tuple[str, ...], **counts: Column) -> DataFrame:
    """The first row of each key, with aggregates over all rows of the key; partly done before the shuffle."""
    rest = [c for c in rows.columns if c not in (*order, key)]
    found = rows.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first"), *(c.alias(name) for name, c in counts.items()))
    return found.select(key, "_first.*", *counts)


def global_row_number(rows: DataFrame, order: tuple[str, ...], name: str = "place") -> DataFrame:
    """rows numbered from 1 in a total order of columns of any kinds, without bringing them together: ranges of the whole
    order are sorted and written each, and shifted by the sizes of the ranges before.  Rows that tie in the whole order come
    in the order of a digest of all their columns, and are spread over ranges by it; so a task that is run again, after
    an executor was lost, gives every row the same range and place.  Rows that are equal altogether, which no place tells apart, are spread by the
    partition that they come from."""
    tie = F.xxhash64(*(F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, VariantType) else F.col(f"`{f.name}`") for f in rows.schema if not isinstance(f.dataType, MapType)))
    ranged = rows.withColumn("_tie", tie).withColumn("_from", F.spark_partition_id()).repartitionByRange(*(F.col(c) for c in order), "_tie", "_from").sortWithinPartitions(*order, "_tie")
    # The partition's number and, in the lower 33 bits, the row's number in it.
    ranged = cut(ranged.drop("_tie", "_from").withColumn("_at", F.monotonically_increasing_id()), "ranges")
    run = F.shiftrightunsigned("_at", 33)
    sizes = ranged.groupBy(run.alias("_run")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_run", before.alias("_before"))  # a row a range
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return ranged.withColumn("_run", run).join(F.broadcast(starts), "_run").withColumn(name, place.cast("long")).drop("_run", "_before", "_at")


def with_banks(rows: DataFrame, order: tuple[str, ...], size: int = BANK_ROWS) -> DataFrame:
    """rows with place and bank_no: every `size` rows of the order are a bank."""
    return global_row_number(rows, order).withColumn("bank_no", F.floor((F.col("place") - 1) / size).cast("long") + 1)


def emit(found: DataFrame, sources: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """All term rows, duplicates dropped, with place and bank_no; made and made_variants say how many rows, and variants
    among them, were equal to each."""
    aliases = resolved_aliases(sources) if aliases is None else aliases
    rows = canonical_terms(found).unionByName(variant_terms(found, sources)).unionByName(redirect_terms(found, aliases))
    rows = rows.withColumn("signature", signature(F.col("glossary")))
    first = first_and_counts(rows, "signature", ORDER, made=F.count(F.lit(1)), made_variants=F.count_if(F.col("term_tags") == "variant"))
    return with_banks(first, ORDER).select(*TERM_COLUMNS, "signature", "place", "bank_no", "made", "made_variants")
