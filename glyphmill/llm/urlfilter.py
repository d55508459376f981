"""URL filters by hashed expressions.

A rule is a host and a path prefix.  Each URL is expanded into all pairs of a host suffix (its last n labels) and a
path prefix (its first m characters), but only for those n and m that some rule has, so the expansion is exact and its
size depends on the rules' shapes, not on the URL.  Expressions are joined with the rules on the first 32 bits of their
SHA-256 and confirmed on the whole digest; then the longest rule wins.

Only expressions of distinct (host, path) pairs are made, so a host or page that holds a third of all rows is expanded
once per task at most.  Pairs that make up more than a HOT-th of all rows - so fewer than HOT of them - get their rows'
verdicts by a broadcast of those few pairs, urls without a host need none, and only the others are joined back by
shuffle.  Up to BROADCAST_RULES rules (they are counted first) are broadcast; more are joined by shuffle,
with the rules repeated over SALTS salts, so that an expression common to very many URLs is spread over as many tasks.
Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import table

BROADCAST_RULES, SALTS, PREFIX_HEX, HOT = 100_000, 32, 8, 500
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values of the contract: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) for each row of pages; rules has host, path and verdict.

    Where no rule fits, rule is null and the verdict is `default`; so it is for null, empty or unparsable urls, whose
    host and path are empty.  Of fitting rules the one with the longest text wins, then the longer host, then block.
    Rules with a null or empty host or a null path fit nothing; a rule given twice counts once.  Repeated rows of pages
    are each judged.  Extra columns play no part.  Without rules every verdict is the default.
    """
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rules = rules.where(F.col("host").isNotNull() & (F.col("host") != "") & F.col("path").isNotNull()).select("host", "path", "verdict").distinct()
    text = F.concat("host", "path")
    facts = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set(_labels(F.col("host"))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    if not facts["n"]:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    digest = F.sha2(text, 256)
    listed = rules.select(F.substring(digest, 1, PREFIX_HEX).alias("short"), digest.alias("rule_digest"), text.alias("rule"), F.length("host").alias("host_length"), "verdict")

    distinct = rows.where(F.col("host") != "").select("host", "path").distinct()
    suffixes = [F.when(_labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in sorted(facts["labels"])]
    prefixes = [F.when(F.length("path") >= m, F.substring("path", 1, m)) for m in sorted(facts["lengths"])]
    wanted = F.array_compact(F.array(*(F.concat(s, p) for s in suffixes for p in prefixes)))
    made = distinct.select("host", "path", F.explode(wanted).alias("expression")).withColumn("digest", F.sha2("expression", 256))
    made = made.withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    if facts["n"] <= BROADCAST_RULES:
        met = made.join(F.broadcast(listed), "short")
    else:
        salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = made.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"])
    met = met.where(F.col("digest") == F.col("rule_digest"))
    best = met.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("length"), "host_length", "verdict", "rule")).alias("best"))
    best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))
    # Rows of hot pairs would meet in one task: the few pairs go to them instead.
    share = rows.where(F.col("host") != "").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    hot = share.where(F.col("n") * HOT > rows.count()).select("host", "path").limit(HOT)
    hot_best = F.broadcast(hot.join(best, ["host", "path"], "left"))
    named, bare = rows.where(F.col("host") != ""), rows.where(F.col("host") == "")
    parts = [
        named.join(hot_best, ["host", "path"]),
        named.join(F.broadcast(hot), ["host", "path"], "left_anti").join(best, ["host", "path"], "left"),
        bare.withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")}),
    ]
    out = reduce(DataFrame.unionByName, parts)
    return out.select(key, "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url of pages."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
QUERIES = {"op2_url_filter": op2_url_filter}
ORACLE = {
    "op2_url_filter": f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {_VALUES}),
parts AS (
  SELECT row_number() OVER () AS k, page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
fits AS (
  SELECT k, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, rverdict DESC) AS place
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (k)
"""
}
