"""All queries of the record engine over the given tables, with their SQL counterparts.

Inputs that the tables don't have (redirects, dirt in texts, faulty rows) are built from them by the same SQL text in
both engines; what is under test is done by the library here and by plain SQL there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.functions import markup, nodes, shapes
from glyphmill.functions import readings as R
from glyphmill.functions import text as T
from glyphmill.operators import aliases, classify, compare, emit, resources, stats, tree, validate
from glyphmill.plans import build
from glyphmill.plans.scratch import cut, scratch_path
from glyphmill.sources import archive, bundle, records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "emit_terms"


def _query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _made(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    """An input built from one table by SQL that both engines read alike."""
    sql = sql.replace("{", "{{").replace("}", "}}").replace(f"FROM {table}", "FROM {source}")
    return spark.sql(sql, source=_table(spark, sf_dir, table))


# Records out of documents: chains, two-cycles, dangling and repeated headwords, navigation records.
RECORDS = """SELECT doc_id AS ordinal,
  CASE WHEN doc_id % 11 = 5 THEN 'x' || CAST(doc_id AS STRING) WHEN doc_id % 13 = 0 THEN 'd' || CAST(doc_id - 1 AS STRING) ELSE 'd' || CAST(doc_id AS STRING) END AS headword,
  CASE WHEN doc_id % 77 = 16 THEN '@@@LINK=x1'
    WHEN doc_id % 11 = 5 THEN '<ul><li>' || text || '</li></ul>'
    WHEN doc_id % 35 IN (3, 10, 31) THEN '@@@LINK=d' || CAST(doc_id + 7 AS STRING) || ' '
    WHEN doc_id % 35 = 17 THEN '@@@LINK=d' || CAST(doc_id - 7 AS STRING)
    WHEN doc_id % 35 = 24 THEN '@@@LINK=d' || CAST(doc_id + 1 AS STRING)
    ELSE text END AS raw
FROM documents"""
_SOURCES = f"""records AS ({RECORDS.replace("STRING", "VARCHAR")}),
sources AS (
  SELECT ordinal AS id, headword,
    CASE WHEN raw LIKE '@@@LINK=%' THEN trim(substr(raw, 9)) END AS redirect,
    CASE WHEN raw LIKE '@@@LINK=%' THEN CASE WHEN headword LIKE 'x%' AND trim(substr(raw, 9)) LIKE 'x%' THEN 'navigation_redirect' END
      WHEN headword LIKE 'x%' AND contains(lower(raw), '<ul') AND NOT contains(lower(raw), '<hdcs') THEN 'navigation' END AS exclusion
  FROM records)"""
_ALIASES = f"""WITH RECURSIVE {_SOURCES},
canonical AS (SELECT id, headword FROM sources WHERE redirect IS NULL AND exclusion IS NULL),
redirects AS (SELECT id, headword, redirect FROM sources WHERE redirect IS NOT NULL AND exclusion IS NULL),
open_redirects AS (SELECT id, headword, redirect FROM redirects WHERE headword NOT IN (SELECT headword FROM canonical)),
walk(target, headword, way, met) AS (
  SELECT DISTINCT redirect, redirect, CAST([] AS BIGINT[]), [redirect] FROM redirects
  UNION ALL SELECT w.target, o.redirect, list_append(w.way, o.id), list_append(w.met, o.redirect) FROM walk w JOIN open_redirects o ON w.headword = o.headword WHERE NOT list_contains(w.met, o.redirect)),
pairs AS (SELECT target, c.id AS canonical_id, min(way) AS way FROM walk w JOIN canonical c ON w.headword = c.headword GROUP BY ALL)"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_made(spark, sf_dir, RECORDS, "documents"))


@_query("classify_records", f"WITH {_SOURCES} SELECT CASE WHEN exclusion IS NOT NULL THEN 'excluded' WHEN redirect IS NOT NULL THEN 'redirect' ELSE 'canonical' END AS kind, coalesce(exclusion, '') AS exclusion, count(*) AS n FROM sources GROUP BY ALL")
def classify_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sources(spark, sf_dir)
    return rows.groupBy("kind", F.coalesce("exclusion", F.lit("")).alias("exclusion")).agg(F.count(F.lit(1)).alias("n"))


@_query("resolve_aliases", f"{_ALIASES} SELECT r.id AS alias_id, r.headword AS alias, canonical_id, row_number() OVER (PARTITION BY r.id ORDER BY way, canonical_id) - 1 AS place FROM redirects r JOIN pairs p ON r.redirect = p.target")
def resolve_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aliases.resolved_aliases(_sources(spark, sf_dir).drop("raw"))


@_query("unresolved_aliases", f"{_ALIASES} SELECT id AS alias_id, headword AS alias, redirect AS target FROM redirects WHERE redirect NOT IN (SELECT target FROM pairs)")
def unresolved_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aliases.unresolved_aliases(_sources(spark, sf_dir).drop("raw"))


def _found(sources: DataFrame) -> DataFrame:
    """Entries without markup: one a canonical row, with made-up alternates."""
    rows = sources.where("kind = 'canonical'")
    alternates = F.array(F.concat(F.lit("d"), F.col("id") + 1), F.concat(F.lit("v"), F.col("id") % 50))
    none = F.expr("cast(array() as array<string>)")
    return rows.select(F.col("id").alias("source_id"), F.lit(0).cast("long").alias("entry_index"), F.col("headword").alias("expression"), F.lit("a").alias("reading"), F.when(F.col("id") % 3 == 0, alternates).otherwise(none).alias("alternates"), F.lit('["g"]').alias("glossary"), F.lit("").alias("omitted_content_id"))


_FOUND = """found AS (SELECT id AS source_id, headword AS expression FROM canonical),
alternates AS (
  SELECT source_id, 1 AS c, 'd' || (source_id + 1) AS alternate FROM found WHERE source_id % 3 = 0
  UNION ALL SELECT source_id, 2, 'v' || (source_id % 50) FROM found WHERE source_id % 3 = 0),
rows AS (
  SELECT 0 AS phase, source_id AS a, 0 AS b, 0 AS c, expression, source_id AS sequence, '' AS term_tags FROM found
  UNION ALL SELECT 0, source_id, 0, c, alternate, source_id, 'variant' FROM alternates WHERE alternate NOT IN (SELECT headword FROM sources)
  UNION ALL SELECT 1, r.id, row_number() OVER (PARTITION BY r.id ORDER BY way, canonical_id) - 1, 0, r.headword, p.canonical_id, 'redirect' FROM redirects r JOIN pairs p ON r.redirect = p.target),
firsts AS (SELECT *, row_number() OVER (PARTITION BY expression, sequence, term_tags ORDER BY phase, a, b, c) AS k FROM rows),
numbered AS (SELECT *, row_number() OVER (ORDER BY phase, a, b, c) AS place FROM firsts WHERE k = 1)"""


@_query("emit_terms", f"{_ALIASES}, {_FOUND} SELECT expression, sequence, term_tags, place, (place - 1) // 10000 + 1 AS bank_no FROM numbered")
def emit_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _sources(spark, sf_dir).drop("raw")
    return emit.emit(_found(sources), sources).select("expression", "sequence", "term_tags", "place", "bank_no")


@_query("emit_redirect_rows", f"{_ALIASES}, {_FOUND} SELECT a AS alias_id, expression, sequence FROM rows WHERE term_tags = 'redirect'")
def emit_redirect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _sources(spark, sf_dir).drop("raw")
    return emit.redirect_terms(_found(sources), aliases.resolved_aliases(sources)).select(F.col("a").alias("alias_id"), "expression", "sequence")


@_query("suppress_variants", "SELECT p_partkey, lower(p_name) AS alternate FROM part WHERE lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_partkey < 40)")
def suppress_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("alternate"))
    heads = part.where("p_partkey < 40").select(F.col("alternate").alias("headword"))
    return emit.suppressed(part, heads).select("p_partkey", "alternate")


@_query("dedupe_first", "SELECT sha256(text) AS signature, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("signature"))
    return emit.first_of_each(docs, "signature", ("doc_id",)).select("signature", "doc_id")


@_query("duplicates_suppressed", "SELECT sha256(text) AS signature, min(doc_id) AS first, count(*) - 1 AS suppressed, count(*) FILTER (lang = 'en') AS english FROM documents GROUP BY text")
def duplicates_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of each text stays, and how many it stands for."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("signature"))
    found = emit.first_and_counts(docs, "signature", ("doc_id",), made=F.count(F.lit(1)), english=F.count_if(F.col("lang") == "en"))
    return found.select("signature", F.col("doc_id").alias("first"), (F.col("made") - 1).alias("suppressed"), "english")


_LINES = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@_query("assign_banks", f"SELECT l_orderkey, l_partkey, l_linenumber, p AS place, (p - 1) // 10000 + 1 AS bank_no FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(_LINES)}) AS p FROM lineitem)")
def assign_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = emit.with_banks(_table(spark, sf_dir, "lineitem").select(*_LINES), _LINES)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "place", "bank_no")


@_query("number_by_text", "SELECT doc_id, row_number() OVER (ORDER BY text, doc_id) AS place FROM documents")
def number_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.global_row_number(_table(spark, sf_dir, "documents").select("doc_id", "text"), ("text", "doc_id")).select("doc_id", "place")


@_query("bank_totals", "WITH b AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 10000 + 1 AS bank_no FROM events) SELECT bank_no, count(*) AS terms FROM b GROUP BY 1")
def bank_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.with_banks(_table(spark, sf_dir, "events").select("event_id"), ("event_id",)).groupBy("bank_no").agg(F.count(F.lit(1)).alias("terms"))


@_query("bank_samples", "WITH b AS (SELECT DISTINCT (row_number() OVER (ORDER BY l_orderkey) - 1) // 1000 + 1 AS bank_no FROM lineitem), n AS (SELECT bank_no, row_number() OVER (ORDER BY bank_no) AS rn, count(*) OVER () AS n FROM b) SELECT bank_no FROM n WHERE rn IN (1, n // 2 + 1, n)")
def bank_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.bank_samples(emit.with_banks(_table(spark, sf_dir, "lineitem").select("l_orderkey"), ("l_orderkey",), 1000))


@_query("sample_per_group", "SELECT lang, source, doc_id, place FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS place FROM documents) WHERE place <= 25")
def sample_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("lang", "source", "doc_id")
    return stats.first_of_group(docs, ["lang", "source"], ["doc_id"]).select("lang", "source", "doc_id", "place")


@_query("distinct_samples", "SELECT text, min(doc_id) AS first FROM documents GROUP BY text ORDER BY first, text LIMIT 100")
def distinct_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.first_distinct(_table(spark, sf_dir, "documents"), "text", "doc_id")


_DIRTY = "SELECT doc_id, '  ' || replace(replace(text, 'é', 'e' || chr(769)), 'ä', 'a' || chr(776)) || chr(12288) || chr(133) AS dirty FROM documents"


@_query("normalize_text", f"SELECT doc_id, sha256(regexp_replace(nfc_normalize(dirty), '^[\\s\\x{{0085}}\\x{{3000}}]+|[\\s\\x{{0085}}\\x{{3000}}]+$', '', 'g')) AS digest FROM ({_DIRTY})")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("  "), F.replace(F.replace("text", F.lit("é"), F.lit("é")), F.lit("ä"), F.lit("ä")), F.lit("　\u0085\x00")).alias("dirty"))
    return dirty.select("doc_id", F.sha2(T.normalize_text(F.col("dirty")), 256).alias("digest"))


# Whole texts with look-alike letters, em spaces and decomposed accents.
_LOOKALIKE = "' ' || replace(replace(translate(text, 'gaek', 'ɡɑｅｋ'), 'é', 'e' || chr(769)), ' en ', chr(8195)) || chr(0)"


@_query("normalize_reading", f"SELECT doc_id, sha256(regexp_replace(nfc_normalize(replace(replace(translate({_LOOKALIKE}, 'ɡɑｅｋ', 'gaek'), chr(8195), ' '), chr(0), '')), '^[\\s\\x{{0085}}]+|[\\s\\x{{0085}}]+$', '', 'g')) AS digest FROM documents")
def normalize_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = F.concat(F.lit(" "), F.replace(F.replace(F.translate("text", "gaek", "ɡɑｅｋ"), F.lit("é"), F.lit("e\u0301")), F.lit(" en "), F.lit("\u2003")), F.lit("\x00"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.normalize_reading(dirty), 256).alias("digest"))


_COMPOSED = "àáâäèéêëìíîïòóôöùúûüÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜǎěǐǒǔāēīōū"


@_query("clean_reading_flag", f"WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '\\s+')) AS word FROM documents) SELECT doc_id, count(*) AS words, count(*) FILTER (word = '' OR regexp_full_match(nfc_normalize(word), '[A-Za-z ,，､、’''\\-{_COMPOSED}]*') AND word = nfc_normalize(word) AND regexp_matches(strip_accents(word), '[A-Za-z]')) AS clean FROM w GROUP BY doc_id")
def clean_reading_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\\s+", -1)).alias("word"))
    words = words.select("doc_id", T.is_clean_reading(F.col("word")).alias("clean"))
    return words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("words"), F.count_if("clean").alias("clean"))


@_query("slash_alternatives", "SELECT doc_id, len(list_distinct(p)) AS parts, sha256(array_to_string(list_sort(list_distinct(p)), '|')) AS digest FROM (SELECT doc_id, string_split(replace(text, ' ', '/') || '/', '/') AS p FROM documents)")
def slash_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.array_distinct(T.split_alternatives(F.concat(F.replace("text", F.lit(" "), F.lit("/")), F.lit("/"))))
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(parts).cast("long").alias("parts"), F.sha2(F.array_join(F.sort_array(parts), "|"), 256).alias("digest"))


# Texts as groups in brackets that tile them or not, by how many words they have.
_BRACKETED = """SELECT doc_id, CASE (length(text) - length(replace(text, ' ', ''))) % 4 WHEN 0 THEN '［' || replace(text, '. ', 'ㄒㄧㄡ］ ［') || '］'
  WHEN 1 THEN '[' || replace(text, '. ', '] [') || ']' WHEN 2 THEN '［' || replace(text, '. ', '］.［') || '］' ELSE text END AS v FROM documents"""


@_query("bracket_extract", f"""WITH w AS ({_BRACKETED}), g AS (SELECT doc_id, v, regexp_replace(v, '［[^［］]*］|\\[[^\\[\\]]*\\]', '', 'g') AS rest FROM w),
t AS (SELECT *, (starts_with(v, '［') OR starts_with(v, '[')) AND regexp_full_match(rest, '\\s*') AS tiled FROM g)
SELECT doc_id, tiled, sha256(CASE WHEN tiled THEN regexp_extract(substr(v, 2), '^[^ㄒ［］\\[\\]]*') ELSE '' END) AS inside FROM t""")
def bracket_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiled = T.bracket_tiles(F.col("v"))
    inside = F.when(tiled, T.before_bopomofo(T.first_bracket(F.col("v")))).otherwise("")
    return _made(spark, sf_dir, _BRACKETED, "documents").select("doc_id", tiled.alias("tiled"), F.sha2(inside, 256).alias("inside"))


@_query("literal_count_replace", "SELECT doc_id, CAST((length(text) - length(replace(text, 'en', ''))) / 2 AS BIGINT) AS n, sha256(CASE WHEN strpos(text, 'en') > 0 THEN substr(text, 1, strpos(text, 'en') - 1) || 'EN!' || substr(text, strpos(text, 'en') + 2) ELSE text END) AS digest FROM documents")
def literal_count_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return _table(spark, sf_dir, "documents").select("doc_id", T.count_literal(text, F.lit("en")).alias("n"), F.sha2(T.replace_first(text, F.lit("en"), F.lit("EN!")), 256).alias("digest"))


@_query("apply_corrections", "SELECT doc_id AS id, CAST(CASE WHEN doc_id % 10 = 0 AND first THEN 1 ELSE 0 END AS BIGINT) AS corrections, sha256(CASE WHEN doc_id % 10 = 0 AND first THEN text || '!' ELSE text END) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS first FROM documents)")
def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("d"), "doc_id").alias("headword"), F.col("text").alias("raw"))
    firsts = emit.first_of_each(docs, "raw", ("id",)).where("id % 10 = 0")
    rules = firsts.select(F.sha2("raw", 256).alias("source_sha256"), "headword", F.col("raw").alias("before"), F.concat("raw", F.lit("!")).alias("after"), F.lit(0).alias("rule"))
    return classify.correct(docs, rules).select("id", "corrections", F.sha2("raw", 256).alias("digest"))


_HREFS = "SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages"


def _hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))


@_query("link_targets", f"SELECT page_id, '?query=' || replace(url_encode(substr(href, 2) || ' é~*'), '%2F', '/') AS target FROM ({_HREFS})")
def link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hrefs(spark, sf_dir)
    return rows.select("page_id", F.concat(F.lit("?query="), T.url_quote(F.concat(F.expr("substr(href, 2)"), F.lit(" é~*")))).alias("target"))


@_query("resource_paths", "SELECT page_id, lower(trim(regexp_extract(url, '^[^:/?#]*://[^/?#]*([^?#]*)', 1), '/')) AS path, lower(regexp_extract(regexp_extract(url, '^[^:/?#]*://[^/?#]*([^?#]*)', 1), '[^./](\\.[^./]+)$', 1)) AS ext FROM pages")
def resource_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "pages").select("page_id", T.resource_path(F.col("url")).alias("path"))
    return rows.select("page_id", "path", T.suffix(F.col("path")).alias("ext"))


@_query("extension_counts", "SELECT coalesce(nullif(lower(regexp_extract(regexp_extract(url, '^[^:/?#]*://[^/?#]*([^?#]*)', 1), '[^./](\\.[^./]+)$', 1)), ''), '<none>') AS ext, count(*) AS n FROM pages GROUP BY 1")
def extension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "pages").select(T.suffix(T.resource_path(F.col("url"))).alias("ext"))
    return resources.extension_counts(rows)


_PACKED = "SELECT DISTINCT 'media/' || substr(sha256(href), 1, 24) || CASE WHEN length(href) % 2 = 0 THEN '.png' ELSE '.jpg' END AS name, href FROM ({h})"


@_query("content_names", _PACKED.format(h=_HREFS))
def content_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.when(F.length("href") % 2 == 0, ".PNG").otherwise(".jpeg")
    return _hrefs(spark, sf_dir).select("href").distinct().select(T.content_name(F.encode("href", "utf-8"), ext).alias("name"), "href")


@_query("missing_resources", f"SELECT DISTINCT href AS name FROM ({_HREFS}) WHERE href NOT IN (SELECT href FROM ({_HREFS}) WHERE page_id % 3 = 0)")
def missing_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hrefs(spark, sf_dir).withColumnRenamed("href", "name")
    return resources.missing(rows, rows.where("page_id % 3 = 0").distinct())


@_query("unused_resources", f"SELECT DISTINCT 'media' || href AS name FROM ({_HREFS}) WHERE href NOT IN (SELECT href FROM ({_HREFS}) WHERE page_id % 3 = 0) ORDER BY name LIMIT 100")
def unused_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hrefs(spark, sf_dir).select("page_id", F.concat(F.lit("media"), "href").alias("name"))
    return resources.unused(rows, rows.where("page_id % 3 = 0"))


# Files out of pages: images that are whole, images that aren't, other files; a third of all under one path.
_FILES = """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'all/Same' ELSE 'p/' || CAST(page_id % 40 AS STRING) END || CASE page_id % 4 WHEN 0 THEN '.gif' WHEN 1 THEN '.GIF' WHEN 2 THEN '.png' ELSE '.txt' END AS name,
  CASE WHEN page_id % 8 = 5 THEN html ELSE 'GIF89a' || html || ';' END AS body FROM pages"""


@_query("resource_catalog", f"""WITH f AS ({_FILES.replace("STRING", "VARCHAR")}), l AS (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY page_id DESC) AS k FROM f)
SELECT lower(name) AS path, page_id AS scan_pos, status, CASE WHEN status = 'kept' THEN 'media/' || substr(sha256(body), 1, 24) || '.gif' ELSE '' END AS output
FROM (SELECT *, CASE WHEN lower(name) LIKE '%.gif' AND body LIKE 'GIF89a%;' THEN 'kept' WHEN lower(name) LIKE '%.txt' THEN 'discarded' ELSE 'unreadable' END AS status FROM l WHERE k = 1)""")
def resource_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).select("path", "scan_pos", "status", F.coalesce("output", F.lit("")).alias("output"))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _made(spark, sf_dir, _FILES, "pages").select("name", F.encode("body", "utf-8").alias("content"), F.col("page_id").alias("scan_pos"))
    return resources.catalog(files)


_KEPT = f"""f AS ({_FILES.replace("STRING", "VARCHAR")}), kept AS (
  SELECT path, 'media/' || substr(sha256(body), 1, 24) || '.gif' AS output FROM (SELECT lower(name) AS path, body, row_number() OVER (PARTITION BY lower(name) ORDER BY page_id DESC) AS k FROM f) WHERE k = 1 AND path LIKE '%.gif' AND body LIKE 'GIF89a%;')"""
# References to them, one of each page, by other spellings of their paths.
_REFS = """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'bres://host/ALL/x/../same.gif' ELSE '/P/' || CAST(page_id % 40 AS STRING) || '%2Egif' END AS src FROM pages"""


@_query("resolve_images", f"WITH {_KEPT} SELECT r.page_id, coalesce(k.output, '') AS output FROM ({_REFS.replace('STRING', 'VARCHAR')}) r LEFT JOIN kept k ON k.path = CASE WHEN r.page_id % 5 = 0 THEN 'all/same.gif' ELSE 'p/' || (r.page_id % 40) || '.gif' END")
def resolve_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _made(spark, sf_dir, _REFS, "pages").withColumn("path", T.resource_path(F.col("src")))
    return resources.resolved(refs, resources.resource_map(_catalog(spark, sf_dir)), strict=False).select("page_id", F.coalesce("output", F.lit("")).alias("output"))


@_query("used_resources", f"WITH {_KEPT} SELECT DISTINCT k.output FROM ({_REFS.replace('STRING', 'VARCHAR')}) r JOIN kept k ON k.path = CASE WHEN r.page_id % 5 = 0 THEN 'all/same.gif' ELSE 'p/' || (r.page_id % 40) || '.gif' END")
def used_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _catalog(spark, sf_dir)
    refs = _made(spark, sf_dir, _REFS, "pages").withColumn("path", T.resource_path(F.col("src")))
    return resources.used_blobs(found, resources.resolved(refs, resources.resource_map(found), strict=False)).select("output")


@_query("resource_counters", f"""WITH {_KEPT}, last AS (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY page_id DESC) AS k FROM f)
SELECT 'resources' AS name, count(*) AS n FROM f UNION ALL SELECT 'image_resources', count(*) FROM kept UNION ALL SELECT 'deduplicated_resources', count(*) - count(DISTINCT output) FROM kept
UNION ALL SELECT 'discarded_non_image_resources', count(*) FROM last WHERE k = 1 AND lower(name) LIKE '%.txt'
UNION ALL SELECT 'unreadable_resources', count(*) FROM last WHERE k = 1 AND lower(name) NOT LIKE '%.txt' AND NOT (lower(name) LIKE '%.gif' AND body LIKE 'GIF89a%;') UNION ALL SELECT 'unsupported_resources', 0""")
def resource_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.counters(_catalog(spark, sf_dir), _table(spark, sf_dir, "pages"))


# What regular expressions can tell of the pages' markup, which is flat where it matters: no comments, no active elements.
_STRIPPED = "regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs')"
_TAGS = f"SELECT page_id, lower(unnest(regexp_extract_all({_STRIPPED}, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages"


@_query("tag_histogram", f"SELECT tag, count(*) AS n FROM ({_TAGS}) WHERE tag NOT IN ({', '.join(repr(t) for t in sorted(markup.DROPPED))}) GROUP BY 1")
def tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select(F.explode(markup.tags(F.col("html"))).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


# Records out of pages: lists are headers, links to words with a t are superscripts, paragraphs are notes, some with a note
# inside, and a letter is a character for private use.
_MARKS = (("<ul>", "<hm>"), ("</ul>", "</hm>"), ('<a href="/t', '<sup><a href="/t'), ("</a>", "</a></sup>"), ("<p><b>", "<duyin>"), ("<br>", "<duyin>n</duyin></duyin>"), ("<p>", "<duyin>"), ("</p>", "</duyin>"), ("ç", "\ue000"))
_TREES = f"SELECT page_id, {reduce(lambda sql, m: f"replace({sql}, '{m[0]}', '{m[1]}')", _MARKS, 'html')} AS html FROM pages"
_SAID = "replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', chr(34)), '&amp;', '&')"
_SHOWN = f"SELECT page_id, {_STRIPPED} AS html FROM ({_TREES})"


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(tree.node_table(_made(spark, sf_dir, _TREES, "pages"), "page_id", "html", whole_references=True), "nodes")


@_query("header_children", f"""WITH l AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<hm>(.*?)</hm>', 1, 's'), '<(li)>(.*?)</li>', 2) AS items FROM ({_SHOWN}))
SELECT page_id, generate_subscripts(items, 1)::INTEGER - 1 AS place, 'li' AS tag, {_SAID.format("regexp_replace(unnest(items), '<[^>]*>', '', 'g')")} AS text FROM l""")
def header_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands right below each header, with all its text."""
    found = _nodes(spark, sf_dir)
    kids = tree.children(found, F.col("tag") == "hm", "page_id").select("page_id", "pre", "place", "tag")
    said = tree.texts(found, F.col("tag") == "li", key="page_id").withColumnRenamed("top", "pre")
    return kids.join(said, ["page_id", "pre"]).select("page_id", "place", "tag", "text")


@_query("outermost_notes", f"""WITH a AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]*>|[^<]+') AS tokens FROM ({_SHOWN})),
t AS (SELECT page_id, generate_subscripts(tokens, 1) AS k, unnest(tokens) AS token FROM a),
d AS (SELECT *, sum(CASE token WHEN '<duyin>' THEN 1 WHEN '</duyin>' THEN -1 ELSE 0 END) OVER w AS after FROM t WINDOW w AS (PARTITION BY page_id ORDER BY k)),
n AS (SELECT *, count(*) FILTER (token = '<duyin>' AND after = 1) OVER (PARTITION BY page_id ORDER BY k) AS note FROM d)
SELECT page_id, note AS nth, sha256(coalesce(string_agg({_SAID.format("token")}, '' ORDER BY k) FILTER (NOT starts_with(token, '<')), '')) AS digest FROM n WHERE after > 0 GROUP BY page_id, note""")
def outermost_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes that stand in no other, numbered, with their whole text."""
    found = _nodes(spark, sf_dir)
    note = F.col("tag") == "duyin"
    inside = tree.outermost(found, note, "page_id").select("page_id", F.col("pre").alias("top"))
    said = tree.texts(found, note, key="page_id").join(inside, ["page_id", "top"])
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("top")).cast("long")
    return said.select("page_id", nth.alias("nth"), F.sha2("text", 256).alias("digest"))


@_query("text_without_superscripts", f"""WITH r AS (SELECT page_id, html, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM ({_SHOWN}))
SELECT page_id, {_SAID.format("array_to_string(regexp_extract_all(nav, '<li><a [^>]*>([^<]*)</a>', 1), '')")} AS shown, sha256({_SAID.format("regexp_replace(regexp_replace(html, '<![^>]*>', '', 'g'), '<[^>]*>', '', 'g')")}) AS digest, contains(regexp_replace(html, '<[^>]*>', '', 'g'), '\ue000') AS private_use FROM r""")
def text_without_superscripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the navigation without superscripts, all text, and whether that has characters for private use."""
    found = _nodes(spark, sf_dir)
    shown = tree.texts(found, F.col("tag") == "nav", ("sup",), "page_id").select("page_id", F.col("text").alias("shown"))
    whole = tree.texts(found, F.col("pre") == 0, key="page_id").select("page_id", F.sha2("text", 256).alias("digest"))
    return shown.join(whole, "page_id").join(tree.private_use(found, "page_id"), "page_id").withColumnRenamed("found", "private_use")


@_query("unknown_tags", f"SELECT tag AS name, CAST(count(*) AS BIGINT) AS n FROM ({_TAGS}) WHERE tag NOT IN ({', '.join(repr(t) for t in sorted({*markup.SHAPES, *markup.DROPPED}))}) GROUP BY 1")
def unknown_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("headword"), F.col("html").alias("raw"))
    return stats.events(markup.parsed(pages), "unknown_tags").orderBy(F.desc("n"), "name")


@_query("private_use_scan", "SELECT source, regexp_matches(translate(text, 'wq', chr(57344) || chr(1048576)), '\\p{Co}') AS found, count(*) AS n FROM documents GROUP BY ALL")
def private_use_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = F.translate("text", "wq", "\ue000\U00100000")
    return _table(spark, sf_dir, "documents").groupBy("source", T.has_private_use(dirty).alias("found")).agg(F.count(F.lit(1)).alias("n"))


@_query("usable_content", "SELECT conv_id, turn, v AS digest, strlen(regexp_replace(x, '[\\p{M}\\p{P}\\p{Z}\\s]+', '', 'g')) > 0 AS usable FROM (SELECT conv_id, turn, sha256(x) AS v, x FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN regexp_replace(text, '[^ .,\\n]+', '…', 'g') ELSE text END AS x FROM conversations))")
def usable_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("turn") % 3 == 0, F.regexp_replace("text", "[^ .,\n]+", "…")).otherwise(F.col("text"))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(text, 256).alias("digest"), T.is_usable(text).alias("usable"))


@_query("codepoint_labels", "SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(translate(text, 'wqx', chr(57344) || chr(1048576) || chr(7)), '[\\p{Co}\\p{Cc}\\p{Cf}]'), lambda c: format('U+{:04X}', unicode(c))))), ',') AS labels FROM documents")
def codepoint_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.translate("text", "wqx", "\ue000\U00100000\x07")
    return _table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.odd_codepoints(odd), ",").alias("labels"))


_QUOTED = "CASE turn % 4 WHEN 0 THEN '「' || text || '」' WHEN 1 THEN text || '」' WHEN 2 THEN '「' || text ELSE '「' END"


@_query("corner_brackets", f"SELECT conv_id, turn, sha256(CASE WHEN starts_with(v, '「') AND ends_with(v, '」') AND length(v) > 1 THEN substr(v, 2, length(v) - 2) ELSE v END) AS digest FROM (SELECT *, {_QUOTED} AS v FROM conversations)")
def corner_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(T.strip_corner_brackets(F.expr(_QUOTED)), 256).alias("digest"))


@_query("executable_text", "SELECT page_id, " + " OR ".join(f"regexp_matches(lower(html), '<{t}\\b')" for t in T.EXECUTABLE) + " OR regexp_matches(lower(html), '\\bon\\w+\\s*=') AS found FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(html, 'script', 'b') ELSE html END AS html FROM pages)")
def executable_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit("script"), F.lit("b"))).otherwise(F.col("html"))
    return _table(spark, sf_dir, "pages").select("page_id", T.looks_executable(html).alias("found"))


# Names out of urls: as they are, with a step up, with a backslash, relative.
_NAMES = "CASE length(url) % 4 WHEN 0 THEN substr(url, 8) WHEN 1 THEN replace(url, '/en/', '/../') WHEN 2 THEN replace(url, '.html', chr(92)) ELSE substr(url, strpos(url, '.')) || '..' END"


@_query("unsafe_paths", f"SELECT page_id, starts_with(name, '/') OR contains(name, chr(92)) OR list_contains(string_split(name, '/'), '..') AS unsafe FROM (SELECT page_id, {_NAMES} AS name FROM pages)")
def unsafe_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _table(spark, sf_dir, "pages").select("page_id", F.expr(_NAMES.replace("strpos(url, '.')", "locate('.', url)")).alias("name"))
    return names.select("page_id", T.is_unsafe_path(F.col("name")).alias("unsafe"))


# Texts with escapes: of letters, in either case, of parts of characters that don't belong together, and cut ones.
_ESCAPED = "SELECT doc_id, replace(replace(replace(replace(replace(replace(text, '%', '+'), 'a', '%61'), 'ü', '%c3%BC'), 'o', '%C3'), 's', '%zz'), '.', '%4;') || '%' AS text FROM documents"


@_query("percent_decode", "SELECT doc_id, sha256(replace(replace(replace(replace(text, '%', '+'), 'o', '\ufffd'), 's', '%zz'), '.', '%4;') || '%') AS digest FROM documents")
def percent_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escapes are undone, what makes no character is marked, and what is no escape stays."""
    return _made(spark, sf_dir, _ESCAPED, "documents").select("doc_id", F.sha2(T.url_unquote(F.col("text")), 256).alias("digest"))


@_query("note_comma", "SELECT doc_id, sha256(rtrim_comma) AS digest FROM (SELECT doc_id, CASE WHEN regexp_matches(t, '[,，]$') THEN left(t, length(t) - 1) ELSE v END AS rtrim_comma FROM (SELECT doc_id, v, regexp_replace(v, '\\s+$', '') AS t FROM (SELECT doc_id, replace(text, '.', ',') || CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE 'x' END AS v FROM documents)))")
def note_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.replace("text", F.lit("."), F.lit(",")), F.when(F.col("doc_id") % 2 == 0, " ").otherwise("x"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.without_note_comma(text), 256).alias("digest"))


@_query("span_numbers", "SELECT l_orderkey, l_linenumber, coalesce(TRY_CAST(v AS INTEGER), -1) AS span FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE CAST(l_shipdate AS VARCHAR) END AS v FROM lineitem)")
def span_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey").cast("string")).otherwise(F.col("l_shipdate").cast("string"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(T.span_number(text), F.lit(-1)).alias("span"))


@_query("json_walk", "SELECT e.event_id, j.fullkey AS path, j.type IN ('OBJECT', 'ARRAY') AS nested FROM events e, json_tree(CAST(e.props AS JSON)) j WHERE j.fullkey <> '$'")
def json_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.walked(_table(spark, sf_dir, "events"), "event_id", "props")


_NESTED = "SELECT event_id, '[' || props || ',{\"a b\":[[],{\"\":' || props || '}],\"é\":[true,null,-1.5e3]}]' AS text FROM events"


@_query("json_values", f"""SELECT event_id, fullkey AS path, CASE WHEN type IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL') THEN lower(type) WHEN type = 'VARCHAR' THEN 'string' ELSE 'number' END AS kind, CASE WHEN type = 'VARCHAR' THEN value->>'$' END AS text
FROM (SELECT event_id, unnest(tree, recursive := true) FROM (SELECT event_id, (SELECT list(j) FROM json_tree(n.text::JSON) j) AS tree FROM ({_NESTED}) n))""")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of texts that nest, with its kind."""
    return nodes.json_table(_made(spark, sf_dir, _NESTED, "events"), "event_id", "text").select("event_id", "path", "kind", "text")


@_query("canonical_json_signature", "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'not json' ELSE sha256('{\"a\":[1,\"é\"],\"t\":\"' || event_type || '\",\"z\":{\"b\":null,\"k\":' || user_id || '}}') END AS signature FROM events")
def canonical_json_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{ "z": {"k": '), "user_id", F.lit(', "b": null}, "t": "'), "event_type", F.lit('", "a": [1, "é"] }'))
    text = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{"), text)).otherwise(text)
    return _table(spark, sf_dir, "events").select("event_id", F.coalesce(F.sha2(T.canonical_json(text), 256), F.lit("not json")).alias("signature"))


# Term rows out of conversations.  Their texts go into the glossary as they are; what is wrong with a row goes by its
# number, by its texts' own characters and lengths.
_Q = "replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't')"
ROWS = f"""SELECT conv_id * 100 + turn AS place, '["' || role || '",' || CASE WHEN length(text) % 7 = 0 THEN CAST(turn AS STRING) ELSE chr(34) || {_Q} || chr(34) END || ',"","",0,' ||
  CASE length(text) % 5 WHEN 0 THEN '{{"x":1}}' WHEN 1 THEN '["' || {_Q} || '"]' ELSE
  '[{{"type":"structured-content","content":{{"tag":"' || CASE WHEN length(text) % 3 = 0 THEN 'div' ELSE 'span' END || '","data":{{"content":"record-entry"}},"lang":"' || CASE WHEN turn % 4 = 0 THEN 'zh' ELSE 'zh-Hans' END ||
  '","content":["' || {_Q} || '",{{"tag":"a","href":"' || CASE WHEN turn % 3 = 0 THEN '?query=' ELSE 'http://' END || role || '","content":"<' || CASE WHEN turn % 5 = 0 THEN 'form' ELSE 'from' END || '>"}},{{"tag":"td","colSpan":' || CAST(turn % 2 AS STRING) ||
  '}},{{"tag":"img","path":"media/' || CAST(turn AS STRING) || '.png","data":{{"content":"entry-image"}}}},{{"tag":"' || CASE WHEN turn % 6 = 0 THEN 'examples' ELSE 'li' END || '","lang":"zh"}}]}}}}]' END || ',' || CAST(conv_id AS STRING) || ',""' || CASE WHEN length(text) % 11 = 0 THEN ',1]' ELSE ']' END AS row
FROM conversations"""
_ROWS = f"""b AS ({ROWS.replace("STRING", "VARCHAR")}),
j AS (SELECT place, row, CAST(row AS JSON) AS v FROM b),
slots AS (SELECT place, v, json_array_length(v) AS n, json_type(v, '$[1]') AS kind, v->>'$[1]' AS reading, json_type(v, '$[5]') AS shape FROM j),
item AS (SELECT place, unnest(from_json(v->'$[5]', '["JSON"]')) AS i FROM slots WHERE n = 8 AND shape = 'ARRAY')"""
_CLEAN = f"(reading = '' OR regexp_full_match(nfc_normalize(reading), '[A-Za-z ,，､、’''\\-{_COMPOSED}]*') AND reading = nfc_normalize(reading) AND regexp_matches(strip_accents(reading), '[A-Za-z]'))"


def _term_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, ROWS, "conversations").select(F.lit(1).cast("long").alias("bank"), "place", "row")


@_query("validate_rows", f"""WITH {_ROWS}
SELECT place, 'not_eight_slots' AS rule FROM slots WHERE n <> 8
UNION ALL SELECT place, CASE WHEN kind <> 'VARCHAR' THEN 'reading_not_text' ELSE 'reading_not_clean' END FROM slots WHERE n = 8 AND (kind <> 'VARCHAR' OR NOT {_CLEAN})
UNION ALL SELECT place, 'glossary_not_array' FROM slots WHERE n = 8 AND shape <> 'ARRAY'
UNION ALL SELECT place, CASE WHEN json_type(i) <> 'OBJECT' THEN 'not_structured' WHEN i->>'$.content.tag' <> 'span' THEN 'no_entry_root' ELSE 'wrong_root_language' END FROM item
  WHERE json_type(i) <> 'OBJECT' OR i->>'$.content.tag' <> 'span' OR i->>'$.content.lang' <> 'zh-Hans'""")
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.row_errors(_term_rows(spark, sf_dir)).select("place", "rule")


_TREE = f"""{_ROWS}, t AS (SELECT j.place, e.fullkey, e.type, e.value AS x FROM j, json_tree(j.v) e),
o AS (SELECT *, x->>'$.tag' AS tag, x->>'$.href' AS href, fullkey = '$[5][0].content' AS top FROM t WHERE type = 'OBJECT'),
s AS (SELECT *, x->>'$' AS text FROM t WHERE type = 'VARCHAR'), eight AS (SELECT place FROM slots WHERE n = 8)"""


@_query("validate_nodes", f"""WITH {_TREE}
SELECT rule, count(*) AS n FROM (
  SELECT 'link_not_internal' AS rule FROM o WHERE NOT starts_with(href, '?')
  UNION ALL SELECT 'executable_text' FROM s WHERE regexp_matches(text, '(?i)<(script|iframe|object|embed|form|audio|video)\\b|\\bon\\w+\\s*=')
  UNION ALL SELECT 'nested_language' FROM o WHERE x->>'$.lang' IS NOT NULL AND NOT (top AND place IN (SELECT place FROM eight))
  UNION ALL SELECT 'bad_colSpan' FROM o WHERE tag = 'td' AND (x->>'$.colSpan')::INT < 1
  UNION ALL SELECT 'unknown_tag' FROM o WHERE tag = 'examples'
  UNION ALL SELECT 'light_keeps_removed' FROM o WHERE tag IN ('img', 'examples')) GROUP BY 1""")
def validate_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.summary(validate.node_errors(validate.nodes(_term_rows(spark, sf_dir)), "light"))


@_query("validation_counters", f"""WITH {_TREE}
SELECT (SELECT count(*) FROM o WHERE top AND place IN (SELECT place FROM eight)) AS structured_glossaries,
  (SELECT count(*) FROM o WHERE top AND tag = 'span' AND place IN (SELECT place FROM eight) AND x->>'$.lang' = 'zh-Hans') AS language_roots,
  (SELECT count(*) FROM o WHERE x->>'$.lang' IS NOT NULL AND NOT (top AND place IN (SELECT place FROM eight))) AS nested_lang_attributes,
  (SELECT count(DISTINCT x->>'$.path') FROM o WHERE tag = 'img') AS referenced_resources""")
def validation_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.counters(validate.nodes(_term_rows(spark, sf_dir)))


# A schema of term rows with nodes that hold nodes.
_TEXT, _DATA = {"type": "string"}, {"$ref": "#/definitions/data"}
_NODE = {"$ref": "#/definitions/node"}


def _element(tags: list[str], needs: tuple[str, ...] = (), **members: dict) -> dict:
    tag = {"type": "string", "const": tags[0]} if len(tags) == 1 else {"type": "string", "enum": tags}
    return {"type": "object", "required": ["tag", *needs], "additionalProperties": False, "properties": {"tag": tag, "data": _DATA, "lang": _TEXT, **members}}


_ELEMENTS = [_element(["span", "div", "li"], content=_NODE), _element(["td"], colSpan={"type": "integer", "minimum": 1}), _element(["img"], ("path",), path=_TEXT), _element(["a"], ("href",), content=_NODE, href={"type": "string", "pattern": "^(?:https?:|\\?)[\\w\\W]*"})]
_ITEM = {"type": "object", "required": ["type"], "oneOf": [
    {"required": ["text"], "additionalProperties": False, "properties": {"type": {"const": "text"}, "text": _TEXT}},
    {"required": ["content"], "additionalProperties": False, "properties": {"type": {"const": "structured-content"}, "content": _NODE}}]}
_LEMMA = {"type": "array", "minItems": 2, "maxItems": 2, "items": [_TEXT, {"type": "array", "items": _TEXT}]}
_SLOTS = [_TEXT, _TEXT, {"type": ["string", "null"]}, _TEXT, {"type": "number"}, {"type": "array", "items": {"oneOf": [_TEXT, _ITEM, _LEMMA]}}, {"type": "integer"}, _TEXT]
_SCHEMA = {
    "definitions": {"node": {"oneOf": [_TEXT, {"type": "array", "items": _NODE}, {"type": "object", "oneOf": _ELEMENTS}]}, "data": {"type": "object", "additionalProperties": _TEXT}},
    "type": "array", "items": {"type": "array", "minItems": 8, "maxItems": 8, "additionalItems": False, "items": _SLOTS},
}


@_query("validate_schema", f"""WITH {_ROWS}, item5 AS (SELECT place, i FROM item WHERE json_type(i) = 'OBJECT')
SELECT place, unnest(['schema maxItems at ', 'schema false at 8']) AS rule FROM slots WHERE n > 8 UNION ALL SELECT place, 'schema type at 1' FROM slots WHERE kind <> 'VARCHAR' UNION ALL SELECT place, 'schema type at 5' FROM slots WHERE shape <> 'ARRAY'
UNION ALL SELECT j.place, 'schema oneOf at 5/0' FROM j WHERE json_type(v, '$[5]') = 'ARRAY' AND json_type(v, '$[5][0]') = 'OBJECT' AND ((v->>'$[5][0].content.content[2].colSpan')::INT < 1 OR v->>'$[5][0].content.content[4].tag' = 'examples')""")
def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.schema_errors(_term_rows(spark, sf_dir), _SCHEMA).select("place", "rule")


@_query("node_text", f"WITH {_TREE} SELECT place, sha256(string_agg(text, '' ORDER BY fullkey)) AS digest FROM s WHERE fullkey LIKE '$[5][0].content.content%' AND (fullkey LIKE '%.content' OR fullkey LIKE '%]') AND fullkey NOT LIKE '%.data.content' GROUP BY 1")
def node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nodes.json_table(_term_rows(spark, sf_dir).withColumnRenamed("place", "line"), "line", "row")
    said = nodes.node_texts(found, "line", (F.col("path") == "$[5][0].content") & (F.col("kind") == "object"))
    return said.select(F.col("line").alias("place"), F.sha2("text", 256).alias("digest"))


@_query("validate_files", f"""WITH f AS (SELECT DISTINCT CASE WHEN page_id % 3 = 0 THEN 'media/' || split_part(url, '/', -1) ELSE {_NAMES} END AS name FROM pages)
SELECT name AS scope, 'unsafe_path' AS rule FROM f WHERE starts_with(name, '/') OR contains(name, chr(92)) OR list_contains(string_split(name, '/'), '..')
UNION ALL SELECT name, 'unsupported_media' FROM f WHERE starts_with(name, 'media/') AND NOT regexp_matches(lower(name), '[^./]\\.(png|jpg|jpeg|gif|webp)$')
UNION ALL SELECT name, 'light_has_media' FROM f WHERE starts_with(name, 'media/') OR regexp_matches(lower(name), '[^./]\\.(png|jpg|jpeg|gif|webp|bmp|tif|tiff|svg)$')
UNION ALL SELECT unnest(['index.json', 'styles.css']), 'missing_file'""")
def validate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("media/"), F.substring_index("url", "/", -1))).otherwise(F.expr(_NAMES.replace("strpos(url, '.')", "locate('.', url)")))
    return validate.file_errors(_table(spark, sf_dir, "pages").select(name.alias("name")).distinct(), "light").select("scope", "rule")


@_query("validate_banks", "SELECT 'term_bank_' || l_linenumber || '.json' AS scope, CASE WHEN l_linenumber = 1 THEN 'bank_not_array' ELSE 'bank_too_large' END AS rule FROM lineitem GROUP BY l_linenumber HAVING l_linenumber = 1 OR count(*) > 100")
def validate_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("bank")).agg(F.count(F.lit(1)).alias("n"))
    return validate.bank_errors(sizes.withColumn("fault", F.when(F.col("bank") == 1, "bank_not_array")), 100).select("scope", "rule")


# Stylesheets out of pages: their markup, with rules before and after it.
_CSS = """SELECT page_id, CASE length(html) % 3 WHEN 0 THEN '[data-sc-content="record-entry"] { color: red; font-family : sans-serif ; } ' WHEN 1 THEN '[data-sc-content="record-entry"] { font-family: serif } b { font-family: sans-serif; } ' ELSE '' END
  || html || CASE length(html) % 5 WHEN 0 THEN ' a { background: url( ''//x/y.png'') }' WHEN 1 THEN ' @import' WHEN 2 THEN ' x.TTF ' WHEN 3 THEN ' x.ttfs url(y.png)' ELSE '' END AS css FROM pages"""


@_query("validate_css", f"""SELECT page_id, concat_ws(',', CASE WHEN contains(css, '@import') OR regexp_matches(css, 'url\\( ?''?(https?:)?//') THEN 'remote_css' END, CASE WHEN regexp_matches(css, '(?i)@font-face|\\.(woff|woff2|ttf|otf|eot)\\b') THEN 'font_in_css' END,
  CASE WHEN NOT regexp_matches(css, 'record-entry"\\] \\{{[^}}]*font-family ?: ?sans-serif ?;') THEN 'no_sans_serif' END) AS rules FROM ({_CSS})""")
def validate_css(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _CSS, "pages").select("page_id", F.array_join(validate.css_errors(F.col("css")), ",").alias("rules"))


# Indexes out of customers: their names, keys and segments decide what is there and what is wrong.
_INDEX = """SELECT c_custkey, '{"title":' || CASE WHEN c_nationkey = 0 THEN '5' ELSE '"' || c_name || '"' END || CASE WHEN c_nationkey = 1 THEN '' ELSE ',"revision":"1"' END || CASE WHEN c_custkey % 3 = 0 THEN ',"isUpdatable":' || CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END ELSE '' END
  || CASE WHEN c_custkey % 5 = 0 THEN ',"indexUrl":"u","downloadUrl":"v"' ELSE '' END || CASE c_custkey % 4 WHEN 0 THEN ',"format":3' WHEN 1 THEN ',"format":4' WHEN 2 THEN ',"version":2.0' ELSE '' END || ',"sourceLanguage":"' || lower(substr(c_mktsegment, 1, CAST(c_custkey % 5 + 1 AS INT))) || '"'
  || CASE WHEN c_custkey % 7 = 0 THEN ',"tagMeta":{"a":{"order":1,"notes":' || CASE WHEN c_custkey % 14 = 0 THEN '"n"' ELSE '0' END || '},"b":{"x":1}}' ELSE '' END || CASE WHEN c_custkey % 23 = 0 THEN '' ELSE '}' END AS text FROM customer"""


@_query("validate_index", f"""SELECT c_custkey, CASE WHEN c_custkey % 23 = 0 THEN 'index_not_object' ELSE concat_ws(',', CASE WHEN c_nationkey = 0 THEN 'missing_title' END, CASE WHEN c_nationkey = 1 THEN 'missing_revision' END, CASE WHEN c_custkey % 4 = 3 THEN 'missing_format' END,
  CASE WHEN c_custkey % 6 = 0 AND c_custkey % 5 <> 0 THEN 'update_without_urls' END, CASE WHEN c_custkey % 5 NOT IN (1, 2) THEN 'bad_sourceLanguage' END, CASE WHEN c_nationkey = 0 OR c_name <> 'Customer#000000007' THEN 'light_title' END) END AS rules FROM customer""")
def validate_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = validate.index_rules(F.col("text"), "light", {"title": "Customer#000000007"})
    return _made(spark, sf_dir, _INDEX, "customer").select("c_custkey", F.array_join(rules, ",").alias("rules"))


_INDEX_SCHEMA = {
    "definitions": {"code": {"type": "string", "pattern": "^[a-z]{2,3}$"}}, "type": "object", "required": ["title", "revision"],
    "properties": {
        "title": _TEXT, "revision": _TEXT, "format": {"type": "integer", "enum": [1, 2, 3]}, "version": {"type": "integer", "enum": [1, 2, 3]}, "isUpdatable": {"type": "boolean", "const": True},
        "sourceLanguage": {"$ref": "#/definitions/code"}, "tagMeta": {"type": "object", "additionalProperties": {"type": "object", "properties": {"order": {"type": "number"}, "notes": _TEXT}, "additionalProperties": False}},
    },
    "anyOf": [{"required": ["format"]}, {"required": ["version"]}], "dependencies": {"isUpdatable": ["indexUrl", "downloadUrl"]},
}


@_query("validate_index_schema", """WITH f AS (SELECT *, c_custkey % 23 = 0 AS bad FROM customer)
SELECT c_custkey, 'type at ' AS fault FROM f WHERE bad UNION ALL SELECT c_custkey, fault FROM f, (SELECT unnest(['type at /title', 'required at /revision', 'enum at /format', 'const at /isUpdatable', 'pattern at /sourceLanguage', 'type at /tagMeta/a/notes', 'additionalProperties at /tagMeta/b/x', 'anyOf at ', 'dependencies at /indexUrl', 'dependencies at /downloadUrl']) AS fault)
WHERE NOT bad AND CASE split_part(fault, ' at ', 2) WHEN '/title' THEN c_nationkey = 0 WHEN '/revision' THEN c_nationkey = 1 WHEN '/format' THEN c_custkey % 4 = 1 WHEN '/isUpdatable' THEN c_custkey % 6 = 3 WHEN '/sourceLanguage' THEN c_custkey % 5 NOT IN (1, 2)
  WHEN '/tagMeta/a/notes' THEN c_custkey % 14 = 7 WHEN '/tagMeta/b/x' THEN c_custkey % 7 = 0 WHEN '' THEN c_custkey % 4 = 3 ELSE c_custkey % 3 = 0 AND c_custkey % 5 <> 0 END""")
def validate_index_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _made(spark, sf_dir, _INDEX, "customer")
    return shapes.faults(texts, _INDEX_SCHEMA, "text", shapes.deepest(texts, "text")).select("c_custkey", F.explode("faults").alias("fault"))


@_query("size_totals", "SELECT count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents")
def size_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.size_totals(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.encode("text", "utf-8").alias("content")))


@_query("row_json", f"SELECT doc_id, sha256('[\"' || lang || '\",\"' || {_Q} || '\",\"\",\"\",0,[],' || doc_id || ',\"\"]') AS digest FROM documents")
def row_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("expression"), F.col("text").alias("reading"), F.lit("").alias("definition_tags"), F.lit("").alias("rules"), F.lit(0).alias("score"), F.lit("[]").alias("glossary"), F.col("doc_id").alias("sequence"), F.lit("").alias("term_tags"))
    return bundle.row_json(docs).select("doc_id", F.sha2("row", 256).alias("digest"))


@_query("bank_files", "SELECT b AS bank_no, sha256('[' || chr(10) || string_agg(r, ',' || chr(10) ORDER BY place) || chr(10) || ']' || chr(10)) AS digest FROM (SELECT place, (place - 1) // 100 + 1 AS b, '[\"' || event_type || '\",\"\",\"\",\"\",0,[],' || event_id || ',\"\"]' AS r FROM (SELECT *, row_number() OVER (ORDER BY event_type, event_id) AS place FROM events)) GROUP BY 1")
def bank_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit("")
    rows = _table(spark, sf_dir, "events").select(F.col("event_type").alias("expression"), none.alias("reading"), none.alias("definition_tags"), none.alias("rules"), F.lit(0).alias("score"), F.lit("[]").alias("glossary"), F.col("event_id").alias("sequence"), none.alias("term_tags"))
    found = bundle.banks(emit.with_banks(rows, ("expression", "sequence"), 100))
    return found.select("bank_no", F.sha2("content", 256).alias("digest"))


@_query("archive_round_trip", "SELECT 'd/' || doc_id AS name, row_number() OVER (ORDER BY 'd/' || doc_id) - 1 AS place, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS digest FROM documents")
def archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a member of an archive that tasks write and tasks read."""
    path = f"{scratch_path(spark, 'archive')}.zip"
    archive.write(_table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "doc_id").alias("name"), F.encode("text", "utf-8").alias("content")), path)
    return archive.members(spark, path, bytes_per_partition=1 << 20).select("name", "place", "size", F.sha2("content", 256).alias("digest"))


@_query("edition_parity", "WITH a AS (SELECT source, lang, doc_id FROM documents), b AS (SELECT source, lang, doc_id FROM documents WHERE length(text) % 50 <> 0 UNION ALL SELECT source, lang, doc_id FROM documents WHERE length(text) % 50 = 1) SELECT doc_id AS sequence, CAST(1 AS INTEGER) AS missing, CAST(0 AS INTEGER) AS extra FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT doc_id, 0, 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def edition_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    full = docs.select(F.col("source").alias("expression"), F.col("lang").alias("reading"), F.lit("").alias("definition_tags"), F.lit("").alias("rules"), F.lit(0).alias("score"), F.col("doc_id").alias("sequence"), F.lit("").alias("term_tags"), F.length("text").alias("size"))
    light = full.where("size % 50 <> 0").union(full.where("size % 50 = 1")).drop("size")
    return compare.edition_parity(full.drop("size"), light).select("sequence", F.col("missing").cast("int").alias("missing"), F.col("extra").cast("int").alias("extra"))


@_query("expected_vs_actual", "SELECT o_orderkey AS sequence, r AS reading FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority || 'x' ELSE o_orderpriority END AS r FROM orders UNION ALL SELECT o_orderkey, o_orderpriority || 'y' FROM orders WHERE o_orderkey % 10 = 0)")
def expected_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sequence"), F.col("o_orderpriority").alias("reading"))
    changes = old.where("sequence % 10 = 0").distinct().withColumn("readings", F.array(F.concat("reading", F.lit("x")), F.concat("reading", F.lit("y"))))
    return compare.expected_rows(old, changes).select("sequence", "reading")


@_query("multiset_difference", "SELECT o_orderkey AS sequence, o_orderstatus AS reading, 1 AS missing, 0 AS extra FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT o_orderkey, o_orderstatus || '!', 0, 1 FROM orders WHERE o_orderkey % 7 = 0")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sequence"), F.col("o_orderstatus").alias("reading"))
    changed = rows.withColumn("reading", F.when(F.col("sequence") % 7 == 0, F.concat("reading", F.lit("!"))).otherwise(F.col("reading")))
    return compare.multiset_difference(rows, changed, ["sequence", "reading"]).select("sequence", "reading", F.col("missing").cast("int").alias("missing"), F.col("extra").cast("int").alias("extra"))


@_query("conflicts", "SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS values FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1")
def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.conflicts(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_suppkey")


@_query("members_by_name", "SELECT 'n' || doc_id AS name, CASE WHEN doc_id % 6 = 0 THEN 'only_left' WHEN doc_id % 6 = 1 THEN 'different' ELSE 'equal' END AS state FROM documents UNION ALL SELECT 'm' || doc_id, 'only_right' FROM documents WHERE doc_id % 6 = 0")
def members_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    left = docs.select(F.concat(F.lit("n"), "doc_id").alias("name"), F.col("text").alias("content"))
    name = F.concat(F.when(F.col("doc_id") % 6 == 0, "m").otherwise("n"), "doc_id")
    right = docs.select(name.alias("name"), F.when(F.col("doc_id") % 6 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("content"))
    return compare.by_name(left, right)


@_query("inventory", "SELECT lang || '.txt' AS name, CAST(sum(strlen(text) + 1) AS BIGINT) AS size, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256 FROM (SELECT doc_id, lang, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM documents) GROUP BY lang")
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and digests of files: the texts of each language, a line each, that are written first, in parts."""
    lines = _table(spark, sf_dir, "documents").select("doc_id", "lang", F.translate("text", "\n\r", "  ").alias("text"))
    folder = scratch_path(spark, "files")
    lines.repartitionByRange("lang", "doc_id").sortWithinPartitions("lang", "doc_id").select("lang", "text").write.partitionBy("lang").text(folder)
    found = records.inventory(spark, folder, "part-*.txt", joined=True)
    return found.select(F.concat(F.regexp_extract("name", "lang=(.*)", 1), F.lit(".txt")).alias("name"), "size", "sha256")


# Pronunciations out of both halves of each line of each document: alternatives, brackets, look-alikes, question marks.
_PRON = """SELECT doc_id, line, CASE length(a) % 6 WHEN 0 THEN a || '/' || b WHEN 1 THEN '［' || a || 'ㄒㄧㄡ］［' || b || '］' WHEN 2 THEN '［' || a || '］' || b WHEN 3 THEN translate(a, 'ae', 'ɑｅ') || '/' || a || '/' WHEN 4 THEN a || CASE WHEN length(b) % 2 = 0 THEN ' ?' ELSE b END ELSE ' ' END AS original
FROM (SELECT doc_id, line, left(text, CAST((length(text) - length(text) % 2) / 2 AS INT)) AS a, substr(text, CAST((length(text) - length(text) % 2) / 2 AS INT) + 1) AS b FROM lines)"""
_READ = f"""WITH lines AS (SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)), p AS ({_PRON}),
v AS (SELECT *, trim(original) AS value FROM p),
c AS (SELECT *, starts_with(value, '［') AS bracketed, starts_with(value, '［') AND regexp_full_match(value, '(［[^［］]*］|\\[[^\\[\\]]*\\]|\\s)+') AS tiled FROM v),
w AS (SELECT *, CASE WHEN tiled THEN trim(regexp_extract(value, '^［([^［］ㄒ]*)', 1)) WHEN bracketed THEN '' ELSE value END AS inner_ FROM c),
x AS (SELECT doc_id, line, original, bracketed, tiled, len(string_split(inner_, '/')) > 1 AS several, unnest(string_split(inner_, '/')) AS raw, generate_subscripts(string_split(inner_, '/'), 1) AS k FROM w),
n AS (SELECT *, trim(nfc_normalize(translate(raw, 'ɑｅ', 'ae'))) AS reading FROM x),
m AS (SELECT *, reading <> '' AND {_CLEAN} AS ok, trim(original) <> '' AS shown FROM n),
reasons AS (
  SELECT doc_id, line, unnest([CASE WHEN tiled THEN 'brackets_extracted' WHEN bracketed THEN 'unrecognized_brackets' END, CASE WHEN several THEN 'slash_alternatives' END, CASE WHEN regexp_matches(raw, '[ɑｅ]') THEN 'letters_normalized' END,
    CASE WHEN contains(raw, 'ｅ') THEN 'width_letters_normalized' END, CASE WHEN NOT ok AND shown THEN CASE WHEN contains(reading, '?') THEN 'unresolved_question_mark' WHEN reading = '' THEN 'unresolved_missing_primary' ELSE 'unresolved_metadata' END END]) AS reason FROM m)"""


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    rows = spark.sql(_PRON.replace("FROM lines", "FROM {lines}"), lines=lines.withColumn("line", F.col("line") + 1))
    return rows.withColumn("r", R.reading(F.col("original"), F.col("original"), F.lit(False)))


@_query("reading_reason_counts", f"{_READ} SELECT reason, count(*) AS n FROM (SELECT DISTINCT doc_id, line, reason FROM reasons WHERE reason IS NOT NULL) GROUP BY 1")
def reading_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.count_each(_readings(spark, sf_dir), "r.reasons", "reason")


@_query("extracted_readings", f"{_READ}, f AS (SELECT doc_id, line, reading, min(k) AS k FROM m WHERE ok GROUP BY ALL) SELECT m.doc_id, CAST(m.line AS INTEGER) AS line, coalesce((SELECT string_agg(reading, ';' ORDER BY f.k) FROM f WHERE f.doc_id = m.doc_id AND f.line = m.line), '') AS readings, bool_or(bracketed OR NOT ok AND shown) AS retain_source FROM m GROUP BY m.doc_id, m.line")
def extracted_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir).select("doc_id", "line", F.array_join("r.readings", ";").alias("readings"), F.col("r.retain_source").alias("retain_source"))


@_query("record_counters", f"WITH {_SOURCES} SELECT unnest(['input_records', 'excluded_records', 'redirect_records', 'canonical_records']) AS name, unnest([count(*), count(exclusion), count(*) FILTER (redirect IS NOT NULL AND exclusion IS NULL), count(*) FILTER (redirect IS NULL AND exclusion IS NULL)]) AS n FROM sources")
def record_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("kind")
    return stats.counters(_sources(spark, sf_dir), input_records=F.lit(True), excluded_records=kind == "excluded", redirect_records=kind == "redirect", canonical_records=kind == "canonical")


# Markup records out of conversations: headwords with forms, readings, senses, examples and images.
MARKED = """SELECT conv_id * 100 + turn AS ordinal, 'h' || CAST(conv_id AS STRING) || 't' || CAST(turn AS STRING) AS headword,
  CASE WHEN turn % 4 = 3 THEN '@@@LINK=h' || CAST(conv_id AS STRING) || 't0'
    ELSE '<hdcs><hdc><hm><hw>' || role || CAST(conv_id AS STRING) || '</hw><simp>s' || CAST(conv_id AS STRING) || '</simp><pron>' || CASE WHEN turn % 2 = 0 THEN 'gā/gà' ELSE 'gā' END || '</pron></hm><item><mean>' || replace(replace(text, '<', ' '), '&', ' ') || '<examples><example>e</example></examples><script>x()</script></mean></item></hdc></hdcs>' END AS raw
FROM conversations"""


def _marked_terms(spark: SparkSession, sf_dir: str, edition: str) -> DataFrame:
    return build.build(_made(spark, sf_dir, MARKED, "conversations"), edition_=edition).terms


_MARKED_SQL = f"""WITH m AS ({MARKED.replace("STRING", "VARCHAR")}),
c AS (SELECT *, conv_id * 100 + turn AS id FROM conversations WHERE turn % 4 <> 3),
heads AS (SELECT headword FROM m),
r AS (SELECT unnest(['gā', 'gà']) AS reading, unnest([0, 1]) AS k),
e AS (SELECT id, conv_id, turn, role || conv_id AS expression, reading FROM c JOIN r ON k = 0 OR turn % 2 = 0),
terms AS (
  SELECT DISTINCT expression, reading, id AS sequence, '' AS term_tags FROM e
  UNION ALL SELECT DISTINCT 's' || conv_id, reading, id, 'variant' FROM e WHERE 's' || conv_id NOT IN (SELECT headword FROM heads)
  UNION ALL SELECT DISTINCT a.headword, e.reading, e.id, 'redirect' FROM m a JOIN m t ON a.raw = '@@@LINK=' || t.headword JOIN e ON e.id = t.ordinal)
SELECT expression, reading, sequence, term_tags FROM terms"""


@_query("build_full_terms", _MARKED_SQL)
def build_full_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked_terms(spark, sf_dir, "full").select("expression", "reading", "sequence", "term_tags")


@_query("build_light_terms", _MARKED_SQL)
def build_light_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked_terms(spark, sf_dir, "light").select("expression", "reading", "sequence", "term_tags")


@_query("build_statistics", _MARKED_SQL.replace("SELECT expression, reading, sequence, term_tags FROM terms", """SELECT * FROM (
  SELECT 'input_records' AS name, count(*) AS n FROM m UNION ALL SELECT 'canonical_records', count(*) FROM c UNION ALL SELECT 'redirect_records', count(*) FROM m WHERE raw LIKE '@@@LINK=%'
  UNION ALL SELECT 'source_pronunciation_blocks', count(*) FROM c UNION ALL SELECT 'slash_alternatives', count(*) FROM c WHERE turn % 2 = 0
  UNION ALL SELECT unnest(['light_removed_examples', 'light_removed_example']), count(*) FROM c
  UNION ALL SELECT 'generated_source_variants', count(*) FROM e WHERE 's' || conv_id NOT IN (SELECT headword FROM heads)
  UNION ALL SELECT 'resolved_redirects', count(*) FROM m a WHERE a.raw LIKE '@@@LINK=%' AND substr(a.raw, 9) IN (SELECT headword FROM m WHERE raw NOT LIKE '@@@LINK=%')
  UNION ALL SELECT 'unresolved_redirects', count(*) FROM m a WHERE a.raw LIKE '@@@LINK=%' AND substr(a.raw, 9) NOT IN (SELECT headword FROM m WHERE raw NOT LIKE '@@@LINK=%')
  UNION ALL SELECT 'light_omission_notices', count(*) FROM c WHERE NOT regexp_matches(text, '[\\p{L}\\p{N}\\p{S}]')
  UNION ALL SELECT 'emitted_terms', count(*) FROM terms
  UNION ALL SELECT 'deduplicated_terms', (SELECT count(*) FROM e) + (SELECT count(*) FROM e WHERE 's' || conv_id NOT IN (SELECT headword FROM heads)) + (SELECT count(*) FROM m a JOIN m t ON a.raw = '@@@LINK=' || t.headword JOIN e ON e.id = t.ordinal) - (SELECT count(*) FROM terms)) WHERE n > 0"""))
def build_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.statistics(build.build(_made(spark, sf_dir, MARKED, "conversations"), edition_="light"))


# Records with pronunciations, out of both halves of each text, that the older bundles had as they were; term rows of both.
_BARE = "replace(replace(replace(text, chr(10), ' '), '.', ''), ',', '')"
_HALF = f"CAST((length({_BARE}) - length({_BARE}) % 2) / 2 AS INT)"
_HALVES = (f"trim(left({_BARE}, {_HALF}))", f"trim(substr({_BARE}, {_HALF} + 1))")
_SPOKEN = """SELECT conv_id * 100 + turn AS ordinal, 'h' || CAST(conv_id AS STRING) AS headword, '<hdc><pron>' || CASE turn % 5 WHEN 0 THEN a || '/' || b WHEN 1 THEN a || '，<duyin>' || b || '</duyin>' WHEN 2 THEN '［' || a || 'ㄒㄧㄡ］［' || b || '］' WHEN 3 THEN a || ' ?' ELSE translate(a, 'ae', 'ɑｅ') || '/' || a END || '</pron><i>' || a || '</i></hdc>' AS raw
FROM (SELECT *, HALF1 AS a, HALF2 AS b FROM conversations)""".replace("HALF1", _HALVES[0]).replace("HALF2", _HALVES[1])
_BECAME = f"""s AS (SELECT conv_id * 100 + turn AS sequence, turn % 5 AS k, nfc_normalize({_HALVES[0]}) AS a, nfc_normalize({_HALVES[1]}) AS b FROM conversations),
q AS (SELECT *, CASE k WHEN 0 THEN a || '/' || b WHEN 1 THEN a || '，' || b WHEN 2 THEN '［' || a || 'ㄒㄧㄡ］［' || b || '］' WHEN 3 THEN a || ' ?' ELSE replace(a, 'e', 'ｅ') || '/' || a END AS reading FROM s),
r AS (SELECT *, CASE WHEN k = 0 AND a <> b AND a <> '' AND b <> '' THEN a || ';' || b WHEN k = 0 AND a = '' THEN b WHEN k = 3 THEN '' ELSE a END AS readings,
  CASE WHEN k IN (2, 3) OR a = '' OR k = 0 AND b = '' THEN 'original' WHEN k = 1 THEN 'notes' END AS kind FROM q)"""


@_query("expected_readings", f"WITH {_BECAME} SELECT sequence, trim(reading) AS reading, readings, coalesce(kind, '') AS kind, coalesce(CASE WHEN kind = 'notes' THEN b WHEN kind = 'original' THEN CASE k WHEN 4 THEN replace(reading, 'a', 'ɑ') ELSE trim(reading) END END, '') AS told FROM r")
def expected_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare.expected_readings(_made(spark, sf_dir, _SPOKEN, "conversations"))
    return found.select("sequence", "reading", F.array_join("readings", ";").alias("readings"), F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("told", F.lit("")).alias("told"))


def _row(reading: str | Column, told: Column, rest: Column) -> Column:
    """The JSON text of a term row, with what is told about its reading, if anything, in a header."""
    said = F.concat(F.lit('{"tag":"div","data":{"content":"reading-metadata"},"content":["'), told, F.lit('"]}'))
    header = F.concat(F.lit('{"tag":"div","data":{"content":"header"},"content":['), said, F.lit("]},"))
    content = F.concat(F.coalesce(header, F.lit("")), F.lit('{"tag":"li","content":["'), rest, F.lit('"]}'))
    return F.concat(F.lit('["e","'), reading, F.lit('","","",0,[{"type":"structured-content","content":{"tag":"span","content":['), content, F.lit("]}}],"), F.col("sequence"), F.lit(',""]')).alias("row")


def _compared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Term rows before and after: some of the later ones are lost, some changed, some say too little."""
    changes = cut(compare.expected_readings(_made(spark, sf_dir, _SPOKEN, "conversations")), "changes")
    rest = F.concat(F.lit("r"), F.col("sequence"))
    old = changes.select(_row("reading", F.lit(None).cast("string"), rest))
    told = F.when(F.col("sequence") % 13 != 0, F.concat(F.when(F.col("kind") == "notes", "读音附注：").when(F.col("kind") == "original", "原文读音："), F.col("told")))
    kept = changes.where("sequence % 7 <> 0").withColumn("each", F.explode("readings"))
    new = kept.select(_row(F.col("each"), told, F.when(F.col("sequence") % 11 == 0, F.concat(F.lit("o"), F.col("sequence"))).otherwise(rest)))
    return compare.cleanup_differences(cut(compare.split_rows(old), "old"), cut(compare.split_rows(new), "new"), changes)


_FANNED = f"{_BECAME}, f AS (SELECT sequence, kind, unnest(string_split(readings, ';')) AS reading, readings, q.reading AS was FROM r AS q)"


@_query("cleanup_differences", f"""WITH {_FANNED}
SELECT problem, sequence, reading FROM (
  SELECT 'missing_row' AS problem, sequence, reading FROM f WHERE sequence % 7 = 0 OR sequence % 11 = 0
  UNION ALL SELECT 'unexpected_row', sequence, reading FROM f WHERE sequence % 7 <> 0 AND sequence % 11 = 0
  UNION ALL SELECT 'metadata_presence', sequence, reading FROM f WHERE sequence % 7 <> 0 AND sequence % 11 <> 0 AND sequence % 13 = 0 AND kind IS NOT NULL)""")
def cleanup_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir)[0].select("problem", "sequence", "reading")


@_query("comparison_counters", f"""WITH {_FANNED}
SELECT 'old_rows' AS name, count(*) AS n FROM r UNION ALL SELECT 'changed_original_rows', count(*) FROM r WHERE readings <> trim(reading) UNION ALL SELECT 'expanded_original_rows', count(*) FROM r WHERE contains(readings, ';')
UNION ALL SELECT 'new_rows', count(*) FROM f WHERE sequence % 7 <> 0 UNION ALL SELECT 'rows_with_retained_pronunciation', count(*) FROM f WHERE sequence % 7 <> 0 AND sequence % 13 <> 0 AND kind IS NOT NULL
UNION ALL SELECT 'expected_rows', count(*) FROM f UNION ALL SELECT 'expected_exact_duplicates', 0""")
def comparison_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir)[1]


@_query("render_pages")
def render_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("ordinal"), F.col("url").alias("headword"), F.col("html").alias("raw"))
    return build.build(pages).terms.select("expression", "reading", "glossary", "sequence", "place", "bank_no")
