"""The whole run: records in, term rows, diagnostics and a bundle out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import markup
from glyphmill.functions import readings as R
from glyphmill.functions import text as T
from glyphmill.operators import classify, emit, resources, stats
from glyphmill.operators.aliases import resolved_aliases
from glyphmill.plans.scratch import cut, cut_and_counted
from glyphmill.sources import bundle


@dataclass(frozen=True)
class Edition:
    """Identity of an edition: what it's called and where its files are."""

    key: str
    title: str
    archive: str
    index: str


EDITIONS = {"full": Edition("full", "Records", "records.zip", "index.json"), "light": Edition("light", "Records Light", "records-light.zip", "index-light.json")}


def edition(name: str) -> Edition:
    if name not in EDITIONS:
        raise ValueError(f"unknown edition {name!r}; expected one of {', '.join(EDITIONS)}")
    return EDITIONS[name]


@dataclass
class Run:
    sources: DataFrame
    parsed: DataFrame
    found: DataFrame
    aliases: DataFrame
    terms: DataFrame
    #: Counters that were observed while the tables were written.
    counts: dict[str, int]
    media: DataFrame | None = None
    catalog: DataFrame | None = None
    scanned: DataFrame | None = None


_IMAGE = r'"tag":"img","path":"((?:[^"\\]|\\.)*)"'


def image_references(found: DataFrame) -> DataFrame:
    """(source_id, entry_index, src, path) of the images that glossaries show; path is the name to look up."""
    src = F.explode(F.array_distinct(F.regexp_extract_all("glossary", F.lit(_IMAGE), F.lit(1))))
    refs = found.select("source_id", "entry_index", src.alias("src"))
    return refs.withColumn("path", T.resource_path(F.col("src")))


def with_images(found: DataFrame, mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """found with packaged names (mapped: path, output) for the sources of images, and the references with their output.
    A source that isn't packaged fails the query."""
    refs = resources.resolved(image_references(found), mapped)
    packed = F.collect_list(F.struct(F.concat(F.lit('"path":"'), "src", F.lit('"')).alias("was"), F.concat(F.lit('"path":"'), "output", F.lit('"')).alias("now")))
    each = refs.groupBy("source_id", "entry_index").agg(packed.alias("_images"))
    met = found.join(each, ["source_id", "entry_index"], "left")
    shown = F.aggregate("_images", F.col("glossary"), lambda text, x: F.replace(text, x["was"], x["now"]))
    return met.withColumn("glossary", F.when(F.col("_images").isNotNull(), shown).otherwise(F.col("glossary"))).drop("_images"), refs


def build(records: DataFrame, rules: DataFrame | None = None, edition_: str = "full", root: str = "record-entry", files: DataFrame | None = None) -> Run:
    """Term rows (with place and bank_no) of records (ordinal, headword, raw), and what they were made from.  files (name,
    content, scan_pos) are the resources of images; without them images keep their sources, and the light edition has none.

    Markup is parsed once, entries are made once and aliases are resolved once; each is written, since variants, redirects
    and statistics all read them.
    """
    edition(edition_)
    classified, kind = classify.classify(records), F.col("kind")
    of_kind = {f"{k}_records": F.count_if(kind == k) for k in ("excluded", "redirect", "canonical")}
    sources, counts = cut_and_counted(classified.drop("raw"), "sources", input_records=F.count(F.lit(1)), **of_kind)
    canonical = classified.where("kind = 'canonical'").select("id", "headword", "raw")
    if rules is not None:
        canonical = classify.correct(canonical, rules)
    parsed = cut(markup.parsed(canonical, edition_).drop("raw"), "parsed")
    found, media, catalog = emit.entries(parsed, root), None, None
    if files is not None and edition_ == "full":
        catalog = cut(resources.catalog(files), "catalog")
        found, refs = with_images(found, resources.resource_map(catalog))
        media = resources.used_blobs(catalog, refs).select(F.col("output").alias("name"), "content")
    block = F.col("reading_no") == 0
    lost = ~F.col("generic") & ~F.col("plain") & (F.size("readings") == 1) & (F.element_at("readings", 1) == "")
    reasons = {reason: F.count_if(block & F.col("has_pron") & F.array_contains("reasons", reason)) for reason in R.REASONS}
    found, seen = cut_and_counted(found, "found", source_pronunciation_blocks=F.count_if(block & F.col("has_pron")), missing_readings=F.count_if(block & lost), **reasons)
    aliases, led = cut_and_counted(resolved_aliases(sources), "aliases", resolved_redirects=F.count_if(F.col("place") == 0))
    terms, emitted = cut_and_counted(emit.emit(found, sources, aliases), "terms", emitted_terms=F.count(F.lit(1)), made=F.sum("made"), generated_source_variants=F.sum("made_variants"))
    counts |= seen | led | emitted
    # What is left out as equal to an earlier row: all that was made, less what is emitted.
    counts["deduplicated_terms"] = counts.pop("made") - counts["emitted_terms"]
    counts["unresolved_redirects"] = counts["redirect_records"] - counts["resolved_redirects"]
    return Run(sources, parsed, found, aliases, terms, counts, media, catalog, files)


def statistics(run: Run) -> DataFrame:
    """(name, n) of every counter of a run that isn't zero.  Most were observed while the run was written; of the rest,
    those of markup are sums over what each record says of itself."""
    one = lambda name, rows: rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    parts = [run.sources.sparkSession.createDataFrame(list(run.counts.items()), "name string, n long"), stats.events(run.parsed)]
    if "corrections" in run.parsed.columns:
        parts.append(run.parsed.agg(F.sum("corrections").alias("n")).select(F.lit("corrections").alias("name"), "n"))
    if run.catalog is not None:
        parts.append(resources.counters(run.catalog, run.scanned))
        parts.append(one("used_resources", run.media))
    return reduce(DataFrame.union, parts).groupBy("name").agg(F.sum("n").alias("n")).where("n > 0")


def report(run: Run, edition_: str = "full") -> dict:
    """What a run did: counters, exclusions, all unknown tags by frequency, resources by ending, and the first samples of
    each reading reason, of missing readings, of private-use characters and of aliases that lead nowhere."""
    one = lambda df: {r[0]: r[1] for r in df.collect()}  # noqa: E731  a few names each
    unknown = stats.events(run.parsed, "unknown_tags").orderBy(F.desc("n"), "name")
    blocks = run.found.where("reading_no = 0 and has_pron").select("expression", "original", "source_id", "block", "readings", F.explode(F.array_distinct("reasons")).alias("reason"))
    samples: dict[str, list] = {}
    for r in stats.first_of_group(blocks, ["reason"], ["source_id", "block"]).orderBy("reason", "place").collect():  # 25 a reason
        samples.setdefault(r["reason"], []).append({"headword": r["expression"], "original": r["original"], "readings": r["readings"]})
    first = lambda rows, value="expression", order="source_id": [r[value] for r in stats.first_distinct(rows, value, order).collect()]
    lost = run.sources.where("kind = 'redirect'").join(run.aliases.select(F.col("alias_id").alias("id")), "id", "left_anti")
    return {
        "edition": edition_,
        "counts": dict(sorted(one(statistics(run)).items())),
        "exclusions": dict(sorted(one(stats.count_by(run.sources.where("exclusion is not null"), "exclusion")).items())),
        "unknown_tags": one(unknown),
        "resource_extensions": dict(sorted(one(resources.extension_counts(run.catalog)).items())) if run.catalog is not None else {},
        "reading_diagnostics": {"counts": {k: run.counts[k] for k in sorted(R.REASONS) if run.counts[k]}, "samples": samples, "sample_limit_per_reason": 25},
        "missing_reading_samples": first(run.found.where("reading_no = 0 and not generic and not plain and reading = ''")),
        "unresolved_pua_samples": first(run.found.where("reading_no = 0 and private_use")),
        "unresolved_redirect_samples": first(lost.select(F.concat_ws(" -> ", "headword", "redirect").alias("expression"), F.col("id").alias("source_id"))),
        "unreadable_resources": [r["path"] for r in run.catalog.where("status in ('unreadable', 'unsupported')").orderBy("path").limit(100).collect()] if run.catalog is not None else [],
    }


def write(run: Run, path: str, index: dict, css: str) -> str:
    """Write a run's bundle; SHA-256 of the file."""
    return bundle.write_bundle(path, run.terms, index, css, run.media)
