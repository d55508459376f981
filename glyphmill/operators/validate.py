"""Validation of bundles: every rule is a predicate that turns rows into error rows (scope, place, rule).

Rules over single term rows are columns; rules over the nodes of a glossary work on the exploded JSON tree; rules over
a bundle's files are small tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import shapes
from glyphmill.functions import text as T
from glyphmill.functions.batches import parts
from glyphmill.functions.markup import LIGHT_DROPPED
from glyphmill.functions.nodes import kind, values
from glyphmill.functions.schema import Schema
from glyphmill.operators.resources import KEPT, RASTERIZED, missing, unused
from glyphmill.plans.scratch import cut
from glyphmill.sources import archive, files
from glyphmill.sources.records import scan_banks

MODES = ("targeted", "exhaustive", "archive-only")
MAX_ERRORS = 1000
#: Characters of rows whose nodes a worker holds at once.
PART = 1 << 19

# Fixed values of the term format: what each member of a node has to be.  A set lists the texts that a member may be.
_SIDES = {"baseline", "sub", "super", "text-top", "text-bottom", "middle", "top", "bottom"}
_LINES = {"underline", "overline", "line-through"}
STYLE: dict[str, object] = {
    "fontStyle": {"normal", "italic"}, "fontWeight": {"normal", "bold"}, "fontSize": str, "color": str, "background": str,
    "backgroundColor": str, "textDecorationStyle": {"solid", "double", "dotted", "dashed", "wavy"}, "textDecorationColor": str,
    "borderColor": str, "borderStyle": str, "borderRadius": str, "borderWidth": str, "clipPath": str, "verticalAlign": _SIDES,
    "textAlign": {"start", "end", "left", "right", "center", "justify", "justify-all", "match-parent"}, "textEmphasis": str,
    "textShadow": str, "margin": str, "padding": str, "paddingTop": str, "paddingLeft": str, "paddingRight": str,
    "paddingBottom": str, "wordBreak": {"normal", "break-all", "keep-all"}, "whiteSpace": str, "cursor": str, "listStyleType": str,
    **{f"margin{side}": lambda v: isinstance(v, str) or _number(v) for side in ("Top", "Left", "Right", "Bottom")},
    "textDecorationLine": lambda v: isinstance(v, str) and v in _LINES | {"none"} or isinstance(v, list) and all(isinstance(x, str) and x in _LINES for x in v),
}
_ANY = lambda v: True  # noqa: E731  content is checked node by node
_SPAN = lambda v: isinstance(v, int) and not isinstance(v, bool) and v >= 1
_SIZE = lambda v: _number(v) and v >= 0
_DATA = lambda v: isinstance(v, dict) and all(isinstance(x, str) for x in v.values())
_STYLE = lambda v: isinstance(v, dict) and not any(True for _ in _broken(v, STYLE))
_BASIC = {"tag": str, "content": _ANY, "data": _DATA, "lang": str}
MEMBERS: dict[str, dict[str, object]] = {
    "br": {"tag": str, "data": _DATA},
    **{t: _BASIC for t in ("ruby", "rt", "rp", "table", "thead", "tbody", "tfoot", "tr")},
    **{t: _BASIC | {"colSpan": _SPAN, "rowSpan": _SPAN, "style": _STYLE} for t in ("td", "th")},
    **{t: _BASIC | {"style": _STYLE, "title": str, "open": bool} for t in ("span", "div", "ol", "ul", "li", "details", "summary")},
    "img": {
        "tag": str, "data": _DATA, "path": str, "width": _SIZE, "height": _SIZE, "title": str, "alt": str, "description": str, "pixelated": bool,
        "imageRendering": {"auto", "pixelated", "crisp-edges"}, "appearance": {"auto", "monochrome"}, "background": bool, "collapsed": bool,
        "collapsible": bool, "verticalAlign": _SIDES, "border": str, "borderRadius": str, "sizeUnits": {"px", "em"},
    },
    "a": {"tag": str, "content": _ANY, "lang": str, "href": lambda v: isinstance(v, str) and v.startswith(("?", "http:", "https:"))},
}
NEEDED = {"img": "path", "a": "href"}
NODE = "scope string, place bigint, tag string, kind string, href string, path string, has_lang boolean, lang string, data_is_map boolean, faults array<string>, text string, is_root boolean"


def _number(v: object) -> bool:
    return isinstance(v, int | float) and not isinstance(v, bool)


def _broken(node: dict, members: dict[str, object]) -> Iterator[str]:
    """Members that a node mustn't have, or that aren't what they have to be."""
    for k, v in node.items():
        rule = members.get(k)
        if rule is None:
            yield "unexpected_key"
        elif isinstance(rule, set):
            if not (isinstance(v, str) and v in rule):
                yield f"bad_{k}"
        elif isinstance(rule, type):
            if not isinstance(v, rule):
                yield f"bad_{k}"
        elif not rule(v):
            yield f"bad_{k}"


def node_faults(node: dict) -> list[str]:
    """Rules of the term format that a node breaks by itself."""
    tag = node.get("tag")
    if tag is None:
        return []
    if not isinstance(tag, str) or tag not in MEMBERS:
        return ["unknown_tag"]
    lost = [f"no_{NEEDED[tag]}"] if tag in NEEDED and NEEDED[tag] not in node else []
    return sorted({*_broken(node, MEMBERS[tag]), *lost})


def row_errors(banks: DataFrame, root: str = "record-entry", lang: str = "zh-Hans") -> DataFrame:
    """Errors (scope, place, rule, detail) of term rows (bank, place, row: JSON text): shape, reading, glossary, root,
    language.  A row is parsed once and all its rules come out of one projection; detail is the reading at fault."""
    scope = F.concat(F.lit("term_bank_"), F.col("bank"), F.lit(".json"))
    rows = banks.select(scope.alias("scope"), "place", F.try_parse_json("row").alias("v"), F.coalesce(F.json_array_length("row"), F.lit(-1)).alias("n"))
    at = lambda path, kind: F.try_variant_get("v", path, kind)
    rows = rows.select("scope", "place", "n", F.col("v").isNull().alias("lost"), F.schema_of_variant(at("$[1]", "variant")).alias("kind"), at("$[1]", "string").alias("reading"), at("$[5]", "array<variant>").alias("items"))
    is_text = F.coalesce(F.col("kind") == "STRING", F.lit(False))
    rules = F.when(F.col("lost"), F.array(F.lit("row_not_json"))).when(F.col("n") != 8, F.array(F.lit("not_eight_slots"))).otherwise(
        F.array_compact(
            F.array(
                F.when(~is_text, "reading_not_text").when(~T.is_clean_reading(F.col("reading")), "reading_not_clean"),
                F.when(F.col("items").isNull(), "glossary_not_array"),
            )
        )
    )

    def of_item(x: Column) -> Column:
        get = lambda path: F.try_variant_get(x, path, "string")
        structured = F.coalesce(get("$.type") == "structured-content", F.lit(False))
        rooted = F.coalesce((get("$.content.tag") == "span") & (get("$.content.data.content") == root), F.lit(False))
        right = F.coalesce(get("$.content.lang") == lang, F.lit(False))
        return F.when(~structured, "not_structured").when(~rooted, "no_entry_root").when(~right, "wrong_root_language")

    items = F.when((F.col("n") == 8) & F.col("items").isNotNull(), F.array_compact(F.transform("items", of_item)))
    found = F.concat(rules, F.coalesce(items, F.expr("cast(array() as array<string>)")))
    rows = rows.select("scope", "place", F.explode(found).alias("rule"), "reading")
    return rows.select("scope", "place", "rule", F.when(F.col("rule").startswith("reading_"), F.col("reading")).alias("detail"))


def _json(text: object) -> object:
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def _roots(slots: object) -> list[dict]:
    """What the structured glossaries of a row begin with."""
    items = slots[5] if isinstance(slots, list) and len(slots) == 8 and isinstance(slots[5], list) else []
    return [i["content"] for i in items if isinstance(i, dict) and i.get("type") == "structured-content" and isinstance(i.get("content"), dict)]


def node_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """NODE of every object and string of the rows in batches (bank, place, row, shaped), a frame for each PART of them."""
    for b in parts(batches, "row", PART):
        out = []
        for bank, place, row, shaped in zip(b["bank"], b["place"], b["row"], b["shaped"], strict=True):
            slots = _json(row)
            roots = {id(x) for x in _roots(slots)}
            where = (f"term_bank_{bank}.json", place)
            for v in values(slots):
                if isinstance(v, str):
                    out.append((*where, None, None, None, None, False, None, True, [], v, False))
                elif isinstance(v, dict):
                    own = [v.get(k) if isinstance(v.get(k), str) else None for k in ("tag", "href", "path", "lang")]
                    out.append((*where, own[0], kind(v), own[1], own[2], "lang" in v, own[3], isinstance(v.get("data", {}), dict), node_faults(v) if shaped else [], None, id(v) in roots))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in NODE.split(", ")])


def nodes(banks: DataFrame, shapes_in: str | None = None) -> DataFrame:
    """Every object and string of the rows' JSON trees, parents first.  shapes_in: a boolean column of the rows whose nodes
    are held against the format's shapes, which take most of the time; without it all are."""
    banks = banks.withColumn("shaped", F.col(shapes_in) if shapes_in else F.lit(True))
    return banks.where("row is not null").select("bank", "place", "row", "shaped").mapInPandas(node_frames, NODE)


def node_errors(found: DataFrame, edition: str = "full", schema: bool = True) -> DataFrame:
    """Errors (scope, place, rule, detail) of nodes: links, active text, nested languages, shapes, and what the light edition
    mustn't have; detail is the link, the text's beginning, the language or the tag at fault."""
    light = F.col("tag").isin(*LIGHT_DROPPED) | F.col("kind").isin(*LIGHT_DROPPED, "entry-image") | ~F.col("data_is_map")
    fault = lambda rule, detail: F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))
    rules: list[Column] = [
        F.when(F.col("href").isNotNull() & ~F.col("href").startswith("?"), fault("link_not_internal", F.col("href"))),
        F.when(T.looks_executable(F.col("text")), fault("executable_text", F.left(F.col("text"), F.lit(80)))),
        F.when(F.col("has_lang") & ~F.col("is_root"), fault("nested_language", F.col("lang"))),
        F.when(F.lit(edition == "light") & F.coalesce(light, F.lit(False)), fault("light_keeps_removed", F.coalesce("tag", "kind"))),
    ]
    all_ = F.array_compact(F.array(*rules))
    shaped = F.transform("faults", lambda x: F.struct(x.alias("rule"), F.col("tag").alias("detail")))
    return found.select("scope", "place", F.inline(F.concat(all_, shaped) if schema else all_))


def counters(found: DataFrame, root: str = "record-entry", lang: str = "zh-Hans") -> DataFrame:
    """One row of what nodes() found: structured_glossaries, language_roots, nested_lang_attributes and
    referenced_resources (different paths of images)."""
    rooted = F.col("is_root") & (F.col("tag") == "span") & (F.col("kind") == root)
    return found.agg(
        F.count_if("is_root").alias("structured_glossaries"),
        F.count_if(rooted & F.coalesce(F.col("lang") == lang, F.lit(False))).alias("language_roots"),
        F.count_if(F.col("has_lang") & ~F.col("is_root")).alias("nested_lang_attributes"),
        F.count_distinct(F.when(F.col("tag") == "img", F.col("path"))).alias("referenced_resources"),
    )


def schema_errors(banks: DataFrame, schema: dict) -> DataFrame:
    """Errors of term rows by a JSON Schema of whole banks: a row is checked as the one row of a bank.  The schema is
    compiled to columns, for as many levels as the rows have; rows beyond shapes.LEVELS are checked one by one."""
    scope = F.concat(F.lit("term_bank_"), F.col("bank"), F.lit(".json"))
    rows = banks.where("row is not null").select(scope.alias("scope"), "place", F.concat(F.lit("["), F.coalesce(F.nullif(F.trim("row"), F.lit("")), F.lit("null")), F.lit("]")).alias("text"))
    most = shapes.deepest(rows, "text")
    deep = shapes.depth(F.col("text")) > shapes.LEVELS
    found = shapes.faults(rows if most <= shapes.LEVELS else rows.where(~deep), schema, "text", min(most, shapes.LEVELS)).select("scope", "place", F.explode("faults").alias("fault"))
    # A path begins with the one row's number.
    rule = F.concat(F.lit("schema "), F.regexp_replace("fault", " at (/0/?)?", " at "))
    found = found.select("scope", "place", rule.alias("rule"))
    return found if most <= shapes.LEVELS else found.unionByName(_deep_errors(rows.where(deep), schema))


def _deep_errors(rows: DataFrame, schema: dict) -> DataFrame:
    """schema_errors() of rows (scope, place, text), a row at a time."""
    checked = Schema(schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for scope, place, text in zip(b["scope"], b["place"], b["text"], strict=True):
                for path, rule in checked.faults(_json(text)):
                    out.append((scope, place, f"schema {rule} at {'/'.join(map(str, path[1:]))}"))
            yield pd.DataFrame(out, columns=["scope", "place", "rule"])

    return rows.mapInPandas(run, "scope string, place long, rule string")


def bank_errors(sizes: DataFrame, limit: int = 10_000) -> DataFrame:
    """Errors of banks (bank, n, fault: why a bank isn't an array of rows, null if it is)."""
    scope = F.concat(F.lit("term_bank_"), F.col("bank"), F.lit(".json"))
    rule = F.coalesce(F.col("fault"), F.when(F.col("n") > limit, "bank_too_large"))
    some = sizes.select(scope.alias("scope"), F.lit(-1).cast("long").alias("place"), rule.alias("rule")).where("rule is not null")
    none = sizes.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("bundle").alias("scope"), F.lit(-1).cast("long").alias("place"), F.lit("no_banks").alias("rule"))
    return some.union(none)


def file_errors(files: DataFrame, edition: str = "full") -> DataFrame:
    """Errors of an archive's names, and of its media."""
    ext = T.suffix(F.col("name"))
    media = F.col("name").startswith("media/")
    rules = [
        F.when(T.is_unsafe_path(F.col("name")), "unsafe_path"),
        F.when(media & ~ext.isin(*KEPT), "unsupported_media"),
        F.when(F.lit(edition == "light") & (media | ext.isin(*KEPT, *RASTERIZED)), "light_has_media"),
    ]
    found = files.select(F.col("name").alias("scope"), F.lit(-1).cast("long").alias("place"), F.explode(F.array_compact(F.array(*rules))).alias("rule"))
    needed = reduce(DataFrame.union, [files.agg(F.count_if(F.col("name") == n).alias("n")).where("n = 0").select(F.lit(n).alias("scope"), F.lit(-1).cast("long").alias("place"), F.lit("missing_file").alias("rule")) for n in ("index.json", "styles.css")])
    return found.union(needed)


def index_rules(index: Column, edition: str = "full", identity: dict | None = None) -> Column:
    """Array of the rules that an index (JSON text) breaks: required keys, update URLs, language codes, the light edition's
    identity; for text that isn't an object, that alone."""
    v = F.try_parse_json(index)
    members = F.try_variant_get(v, "$", "map<string,variant>")
    has = lambda k: F.map_contains_key(members, k)
    get = lambda k, kind="string": F.try_variant_get(F.try_element_at(members, F.lit(k)), "$", kind)
    is_text = lambda k: has(k) & F.coalesce(F.schema_of_variant(F.try_element_at(members, F.lit(k))) == "STRING", F.lit(False))
    # Anything but false, null, zero and what is empty switches updates on.
    off = F.coalesce(get("isUpdatable"), F.lit("")).isin("", "false", "0", "0.0", "[]", "{}")
    rules = [F.when(~is_text(k), f"missing_{k}") for k in ("title", "revision")]
    rules += [F.when(~has("format") & ~has("version"), "missing_format"), F.when(~off & ~(has("indexUrl") & has("downloadUrl")), "update_without_urls")]
    rules += [F.when(has(k) & ~(is_text(k) & F.coalesce(get(k).rlike(r"^\p{Ll}{2,3}\z"), F.lit(False))), f"bad_{k}") for k in ("sourceLanguage", "targetLanguage")]
    if edition == "light":
        same = lambda k, value: F.to_json(F.try_element_at(members, F.lit(k))) == F.to_json(F.parse_json(F.lit(json.dumps(value))))
        rules += [F.when(~F.coalesce(same(k, value), F.lit(False)), f"light_{k}") for k, value in (identity or {}).items()]
    return F.when(members.isNull(), F.array(F.lit("index_not_object"))).otherwise(F.array_compact(F.array(*rules)))


# Fixed values of the rule: what a stylesheet mustn't hold - imports, addresses elsewhere, fonts of its own and their files.
IMPORT, ELSEWHERE, FONT_FACE = "@import", r"""(?i)url\s*\(\s*["']?(https?:)?//""", "(?i)@font-face"
FONT_FILES = ("woff", "woff2", "ttf", "otf", "eot")


def css_errors(css: Column, root: str = "record-entry") -> Column:
    """Array of the rules that a stylesheet breaks: nothing from elsewhere, no fonts of its own, and the generic
    sans-serif family for the root of entries."""
    elsewhere = css.contains(IMPORT) | css.rlike(ELSEWHERE)
    fonts = css.rlike(FONT_FACE) | css.rlike(rf"(?i)\.({'|'.join(FONT_FILES)})\b")
    # The declarations of all blocks for the root.
    blocks = F.regexp_extract_all(css, F.lit(rf"""(?is)\[data-sc-content=["']{root}["']\]\s*\{{([^}}]*)"""), F.lit(1))
    sans = F.exists(blocks, lambda block: block.rlike(r"(?i)font-family\s*:\s*sans-serif\s*;"))
    return F.array_compact(F.array(F.when(elsewhere, "remote_css"), F.when(fonts, "font_in_css"), F.when(~sans, "no_sans_serif")))


def sampled(banks: DataFrame, mode: str) -> DataFrame:
    """The banks whose shapes are checked in a mode."""
    from glyphmill.operators.stats import bank_samples

    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {', '.join(MODES)}")
    return banks if mode == "exhaustive" else banks.limit(0) if mode == "archive-only" else banks.join(F.broadcast(bank_samples(banks, "bank")), "bank", "left_semi")


def capped(errors: DataFrame, most: int = MAX_ERRORS) -> DataFrame:
    """The first errors by scope, place and rule: what a report shows."""
    return errors.orderBy(*errors.columns).limit(most)


def summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def size_totals(members: DataFrame) -> DataFrame:
    """(files, bytes) of an archive's members (name, content), uncompressed."""
    return members.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).alias("bytes"))


def _told(r) -> str:
    place = f"{r['scope']}[{r['place']}]" if r["place"] >= 0 else r["scope"]
    return f"{place}: {r['rule']}" + (f": {r['detail']}" if r["detail"] is not None else "")


def _some(errors: DataFrame, what: str) -> list[str]:
    """The first errors, and how many are left."""
    n = errors.count()
    return [_told(r) for r in capped(errors).collect()] + ([f"{n - MAX_ERRORS} more {what}"] if n > MAX_ERRORS else [])


def digested(spark: SparkSession, path: str) -> tuple[int, str]:
    """Bytes and SHA-256 of a file, told by a task that reads it a part at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([files.digest(p) for p in b["path"]], columns=["size", "sha256"])

    return tuple(spark.createDataFrame([(path,)], "path string").mapInPandas(run, "size long, sha256 string").first())


def validate_bundle(spark: SparkSession, path: str, edition: str = "full", mode: str = "targeted", root: str = "record-entry", identity: dict | None = None, schemas: dict[str, dict] | None = None) -> dict:
    """A whole archive against all rules: counts, the first errors, warnings.  schemas: JSON Schemas named index and
    term-bank, which then decide on shapes in place of the built-in rules.

    Names and sizes come from the archive's directory, banks are read once, by as many tasks as they take, and of other
    members the index and the stylesheet alone.  Shapes are looked at in the banks of the mode only.
    """
    schemas = schemas or {}
    size, sha256 = digested(spark, path)
    listed = cut(archive.members(spark, path, content=False).select("name", "size"), "names")
    scanned = cut(scan_banks(spark, path), "banks")
    sizes, banks = scanned.where("place < 0").select("bank", "n", "fault"), scanned.where("place >= 0").select("bank", "place", "row")
    chosen = cut(sampled(sizes.where("fault is null"), mode).select("bank").distinct(), "shapes")
    by_schema = "term-bank" in schemas
    flagged = banks.join(F.broadcast(chosen.withColumn("in_mode", F.lit(True))), "bank", "left").withColumn("in_mode", F.coalesce("in_mode", F.lit(False)) & F.lit(not by_schema))
    found = cut(nodes(flagged, "in_mode"), "nodes")
    rows = row_errors(banks, root).union(node_errors(found, edition))
    if by_schema and mode != "archive-only":
        rows = rows.union(schema_errors(banks.join(F.broadcast(chosen), "bank", "left_semi"), schemas["term-bank"]).withColumn("detail", F.lit(None).cast("string")))
    names = listed.select("name")
    shown = found.where("tag = 'img' and path is not null").select(F.col("path").alias("name"))
    lost = missing(shown, names).select(F.col("name").alias("scope"), F.lit(-1).cast("long").alias("place"), F.lit("missing_resource").alias("rule"))
    of_files = reduce(DataFrame.union, [bank_errors(sizes), file_errors(names, edition), lost]).withColumn("detail", F.lit(None).cast("string"))
    errors = _some(cut(rows, "errors"), "errors of rows") + _some(cut(of_files, "errors"), "errors of files")
    small = {r["name"]: bytes(r["content"]) for r in archive.members(spark, path, names=r"index\.json|styles\.css").select("name", "content").collect()}
    if "index.json" in small:
        if "index" in schemas:
            errors += [f"index.json: schema {rule} at {'/'.join(map(str, where))}" for where, rule in Schema(schemas["index"]).faults(_json(small["index.json"]))]
        if "index" not in schemas or edition == "light":
            text = spark.createDataFrame([(small["index.json"].decode("utf-8", "replace"),)], "text string")
            errors += [f"index.json: {e}" for e in text.select(index_rules(F.col("text"), edition, identity).alias("e")).first()["e"]]
    if "styles.css" in small:
        css = spark.createDataFrame([(small["styles.css"].decode("utf-8", "replace"),)], "css string")
        styles = css.select(css_errors(F.col("css"), root).alias("e")).first()["e"]
        errors += [f"styles.css: {e}" for e in styles]
    total = sizes.agg(F.count(F.lit(1)).alias("banks"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    idle = cut(unused(names, shown), "unused")
    n_idle = idle.count()
    warnings = [f"unused resource: {r['name']}" for r in idle.orderBy("name").limit(MAX_ERRORS).collect()] + ([f"{n_idle - MAX_ERRORS} more unused resources"] if n_idle > MAX_ERRORS else [])
    return {
        "path": path, "edition": edition, "sha256": sha256, "size": size, "uncompressed": listed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"],
        "valid": not errors, "mode": mode, "term_banks": total["banks"], "terms": total["terms"], "schema_validated_banks": sorted(r["bank"] for r in chosen.collect()),
        **counters(found, root).first().asDict(), "css_uses_sans_serif": "styles.css" in small and "no_sans_serif" not in styles, "errors": errors, "warnings": warnings,
    }


def report(result: dict) -> str:
    """A validation result as text."""
    lines = [f"valid: {str(result.get('valid', False)).lower()}"]
    lines += [f"{k}: {v}" for k, v in result.items() if k not in ("valid", "errors", "warnings")]
    return "\n".join([*lines, *(f"error: {e}" for e in result.get("errors", [])), *(f"warning: {w}" for w in result.get("warnings", []))])
