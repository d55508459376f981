import hashlib
import json
import struct
import unicodedata
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import images
from glyphmill.functions import markup as M
from glyphmill.functions import readings as R
from glyphmill.functions import text as T
from glyphmill.functions.schema import Schema
from glyphmill.operators import aliases, classify, compare, emit, resources, stats, validate
from glyphmill.plans import build
from glyphmill.sources import archive, bundle, container, files, records
from tests import containers


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


# Fixed cases: pronunciation, readings, reasons.
CASES = [
    ("chuán fěnɡ/chuán fènɡ", ["chuán fěng", "chuán fèng"], ["slash_alternatives", "letters_normalized"]),
    ("ɡā/gā/gà", ["gā", "gà"], ["slash_alternatives", "letters_normalized"]),
    ("［xiū ㄒㄧㄡ］［…］", ["xiū"], ["brackets_extracted"]),
    ("［音未详。］", [""], ["brackets_extracted", "unresolved_metadata"]),
    ("［xiū］unrecognized", [""], ["unrecognized_brackets", "unresolved_missing_primary"]),
    ("yāo ?", [""], ["unresolved_question_mark"]),
    ("\U00100000 mā", [""], ["unresolved_private_use"]),
    ("gā/?", ["gā"], ["slash_alternatives", "unresolved_question_mark"]),
    ("gā/", ["gā"], ["slash_alternatives", "unresolved_missing_primary"]),
    (" ", [""], []),
]


@pytest.mark.parametrize(("source", "want", "reasons"), CASES)
def test_readings(spark, source, want, reasons):
    got = one(spark, R.reading(F.col("s"), F.col("s"), F.lit(False)), s=source)
    assert got["readings"] == want and got["reasons"] == reasons
    assert got["unresolved"] == (["U+100000"] if "\U00100000" in source else [])


@pytest.mark.parametrize("dirty", ["péng ", "\tpéng", "nǐ2", "ɡuó", "mɑ", "ｅr", "xī?", "hǎo/hào", "(tā)", "tā–", "\ue000", "wǒ\u2003men", "e\u0301", "ñu", "，", "漢"])
def test_dirty_readings(spark, dirty):
    assert one(spark, T.is_clean_reading(F.col("s")), s=dirty) is False


@pytest.mark.parametrize("clean", ["", "péng", "nǚ, lǜ", "zhōng guó", "tiān'é", "bú-yào、ba", "ê̄"])
def test_clean_readings(spark, clean):
    assert one(spark, T.is_clean_reading(F.col("s")), s=clean) is True


def test_text_functions(spark):
    assert one(spark, T.normalize_text(F.col("s")), s="　é\x85\x1c") == "é"
    assert one(spark, T.url_unquote(F.col("s")), s="a+b%20c") == "a+b c"
    assert one(spark, T.url_unquote(F.col("s")), s="a%zz%41%") == "a%zzA%"
    assert one(spark, T.casefold(F.col("s")), s="Straße ǅ") == "Straße ǅ".casefold()
    assert one(spark, T.resource_path(F.col("s")), s="bres://host/A\\.\\b\\..\\C%20d.PNG") == "a/c d.png"
    assert one(spark, T.replace_first(F.col("s"), F.lit("$"), F.lit("\\1")), s="a$b$") == "a\\1b$"
    assert one(spark, T.without_note_comma(F.col("s")), s="a，b，  ") == "a，b"
    assert one(spark, T.canonical_json(F.col("s")), s='{"b":1.5,"a":[null,"é"]}') == '{"a":[null,"é"],"b":1.5}'


ALIASES = [(1, "漢", None, None), (2, "漢", None, None), (3, "汉", "漢", None), (4, "汉字", "汉", None), (5, "甲", "乙", None), (6, "乙", "甲", None), (7, "x1", "x2", "navigation_redirect")]
SOURCES = "id long, headword string, redirect string, exclusion string"


def test_alias_graph(spark):
    rows = spark.createDataFrame(ALIASES, SOURCES)
    got = {(r["alias"], r["canonical_id"], r["place"]) for r in aliases.resolved_aliases(rows).collect()}
    assert got == {("汉", 1, 0), ("汉", 2, 1), ("汉字", 1, 0), ("汉字", 2, 1)}
    assert {r["alias"] for r in aliases.unresolved_aliases(rows).collect()} == {"甲", "乙"}


def test_classification(spark):
    rows = [(1, "a", "@@@LINK= 漢 \r\n\x00"), (2, "b", "<hdcs>x</hdcs>"), (3, "x9", "<UL><li>n</li></UL>"), (4, "x12", "@@@LINK=x34"), (5, "汉", "@@@LINK=漢"), (6, "c", '<ul class="entry-id">'), (7, "d", "@@@LINK=")]
    got = {r["id"]: (r["kind"], r["redirect"], r["exclusion"]) for r in classify.classify(spark.createDataFrame(rows, "ordinal long, headword string, raw string")).collect()}
    assert got[1] == ("redirect", "漢", None) and got[2] == ("canonical", None, None) and got[3] == ("excluded", None, "navigation")
    assert got[4] == ("excluded", "x34", "navigation_redirect") and got[5][0] == "redirect" and got[6][0] == "excluded" and got[7] == ("redirect", "", None)


def test_corrections_must_match_once(spark):
    rows = spark.createDataFrame([(1, "h", "abcabc")], "id long, headword string, raw string")
    rule = lambda before: rows.select(F.sha2("raw", 256).alias("source_sha256"), "headword", F.lit(before).alias("before"), F.lit("!").alias("after"), F.lit(0).alias("rule"))
    assert classify.correct(rows, rule("bca")).first()["raw"] == "a!bc"
    with pytest.raises(Exception, match="exactly once"):
        classify.correct(rows, rule("abc")).collect()


RECORDS = [
    (1, "傳", "<hdcs><hdc><hm><hw>傳</hw><simp>传</simp><pron>ɡā</pron></hm><item><mean>ɡ</mean></item></hdc></hdcs>"),
    (2, "別", "@@@LINK=傳"),
    (3, "别", "@@@LINK=別"),
]


def test_build(spark):
    run = build.build(spark.createDataFrame(RECORDS, "ordinal long, headword string, raw string"))
    rows = run.terms.orderBy("place").collect()
    assert [(r["expression"], r["reading"], r["term_tags"]) for r in rows] == [("傳", "gā", ""), ("传", "gā", "variant"), ("別", "gā", "redirect"), ("别", "gā", "redirect")]
    assert {r["sequence"] for r in rows} == {1} and len({r["glossary"] for r in rows}) == 1 and "ɡ" in rows[0]["glossary"]
    json.loads(rows[0]["glossary"])
    counts = {r["name"]: r["n"] for r in build.statistics(run).collect()}
    assert counts["source_pronunciation_blocks"] == 1 and counts["letters_normalized"] == 1 and counts["emitted_terms"] == 4 and "unresolved_redirects" not in counts


def test_alternatives_give_rows_for_each_reading(spark):
    raw = "<hdc><hm><hw>傳</hw><simp>传</simp><pron>gā/gà</pron></hm><item>x</item></hdc>"
    rows = [(1, "傳", raw), (2, "別", "@@@LINK=傳"), (3, "别", "@@@LINK=別"), (4, "音", "<hdc><hm><hw>音</hw><pron>\U00100000</pron></hm><item>y</item></hdc>")]
    terms = build.build(spark.createDataFrame(rows, "ordinal long, headword string, raw string")).terms.collect()
    assert len([t for t in terms if t["reading"]]) == 8 and [t["expression"] for t in terms if not t["reading"]] == ["音"]
    assert "U+100000" in next(t["glossary"] for t in terms if not t["reading"])


def test_editions_have_the_same_lookup_rows(spark):
    block = "<hdc><hm><hw>a</hw><pron>gā</pron></hm><item>x<examples>{}</examples></item></hdc>"
    frame = spark.createDataFrame([(1, "a", block.format(1) + block.format(2) + block.format(2))], "ordinal long, headword string, raw string")
    full, light = (build.build(frame, edition_=e).terms for e in ("full", "light"))
    assert full.count() == light.count() == 2
    with pytest.raises(ValueError, match="unknown edition"):
        build.build(frame, edition_="tiny")


def test_bundle_is_deterministic_and_valid(spark, tmp_path):
    terms = build.build(spark.createDataFrame(RECORDS, "ordinal long, headword string, raw string")).terms
    index = bundle.index("T", "1", sourceLanguage="zh")
    css = '[data-sc-content="record-entry"] { font-family: sans-serif; }'
    paths = [str(tmp_path / f"{i}.zip") for i in range(2)]
    sums = [bundle.write_bundle(p, terms.repartition(n), index, css) for p, n in zip(paths, (1, 4), strict=True)]
    assert sums[0] == sums[1]
    with zipfile.ZipFile(paths[0]) as z:
        assert z.namelist() == ["index.json", "styles.css", "term_bank_1.json"]
        assert len(json.loads(z.read("term_bank_1.json"))) == 4
    banks = records.read_banks(spark, paths[0])
    assert banks.count() == 4
    assert validate.row_errors(banks).count() == 0 and validate.node_errors(validate.nodes(banks)).count() == 0
    assert validate.file_errors(records.read_members(spark, paths[0])).count() == 0
    assert records.inventory(spark, str(tmp_path)).where(F.col("sha256") == sums[0]).count() == 2


def test_inventory_goes_on_from_task_to_task(spark, tmp_path, monkeypatch):
    """Files longer than a task digests, and files in parts, have the digests of their whole bytes."""
    monkeypatch.setattr(records, "SEGMENT", 100)
    sizes = {"a": [100, 1, 257], "b": [1], "c": [63, 1, 36], "d e": [1000]}
    whole = {}
    for k, (name, parts) in enumerate(sizes.items()):
        (tmp_path / name).mkdir()
        for i, n in enumerate(parts):
            data = np.random.default_rng([k, i]).bytes(n)
            (tmp_path / name / f"part-{i}").write_bytes(data)
            whole[name] = whole.get(name, b"") + data
    want = lambda found: {(name, len(data), hashlib.sha256(data).hexdigest()) for name, data in found.items()}
    assert {tuple(r) for r in records.inventory(spark, str(tmp_path), joined=True).collect()} == want(whole)
    for name, data in whole.items():
        (tmp_path / f"{name}.bin").write_bytes(data)
    assert {tuple(r) for r in records.inventory(spark, str(tmp_path), "*.bin").collect()} == want({f"{k}.bin": v for k, v in whole.items()})


def test_digest_is_put_aside_and_taken_up():
    data = np.random.default_rng(7).bytes(1000)
    for at in (0, 1, 64, 100, 1000):
        first = files.Sha256()
        first.update(data[:at])
        rest = files.Sha256(first.state())
        rest.update(data[at:])
        assert rest.hexdigest() == rest.hexdigest() == hashlib.sha256(data).hexdigest()


GOOD = ["e", "ā", "", "", 0, [{"type": "structured-content", "content": {"tag": "span", "data": {"content": "record-entry"}, "lang": "zh-Hans", "content": ["x"]}}], 1, ""]


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda r: ["e", "", []], "not_eight_slots"),
        (lambda r: [r[0], 5, *r[2:]], "reading_not_text"),
        (lambda r: [r[0], "ā?", *r[2:]], "reading_not_clean"),
        (lambda r: [*r[:5], {}, *r[6:]], "glossary_not_array"),
        (lambda r: [*r[:5], ["t"], *r[6:]], "not_structured"),
        (lambda r: json.loads(json.dumps(r).replace('"span"', '"div"')), "no_entry_root"),
        (lambda r: json.loads(json.dumps(r).replace("zh-Hans", "zh")), "wrong_root_language"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "a", "href": "http://x"}]')), "link_not_internal"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '["<iframe "]')), "executable_text"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "td", "lang": "zh"}]')), "nested_language"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "td", "rowSpan": 0}]')), "bad_rowSpan"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "br", "x": 0}]')), "unexpected_key"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "tr", "style": {}}]')), "unexpected_key"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "div", "style": {"fontStyle": "bold"}}]')), "bad_style"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "div", "style": {"marginTop": 2, "textDecorationLine": ["underline"]}, "open": 1}]')), "bad_open"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "img", "path": "media/x.png", "width": -1}]')), "bad_width"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "img"}]')), "no_path"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "ruby", "content": [{"tag": "rt", "data": {"a": 1}}]}]')), "bad_data"),
        (lambda r: json.loads(json.dumps(r).replace('["x"]', '[{"tag": "video"}]')), "unknown_tag"),
    ],
)
def test_each_fault_breaks_one_rule(spark, change, rule):
    banks = spark.createDataFrame([(1, 0, json.dumps(change(GOOD), ensure_ascii=False))], "bank long, place long, row string")
    errors = validate.row_errors(banks).union(validate.node_errors(validate.nodes(banks)))
    assert [r["rule"] for r in errors.collect()] == [rule]


def whole(kind, body=b""):
    """A small whole image of a kind."""
    pixels = np.full((2, 3, 3), 7, np.uint8) + np.frombuffer(body.ljust(3, b"\0")[:3], np.uint8)
    line = lambda p: (p[:, ::-1].tobytes() + b"\0" * 3)[:12]
    return {
        ".png": images.png(pixels),
        ".jpg": b"\xff\xd8\xff" + body + b"\xff\xd9",
        ".gif": b"GIF89a" + b"0" * 8 + body + b";",
        ".webp": b"RIFF" + (len(body) + 4).to_bytes(4, "little") + b"WEBP" + body,
        ".bmp": b"BM" + bytes(8) + (54).to_bytes(4, "little") + struct.pack("<IiiHHI", 40, 3, 2, 1, 24, 0) + bytes(20) + b"".join(line(pixels[i]) for i in (1, 0)),
    }[kind]


def test_images():
    for kind in (".png", ".jpg", ".gif", ".webp"):
        assert images.normalize(whole(kind, b"x"), kind) == ("kept", whole(kind, b"x"), kind)
        assert images.normalize(whole(kind)[:-2], kind)[0] == "unreadable" and images.normalize(b"", kind)[0] == "unreadable"
    assert images.normalize(whole(".jpg"), ".jpeg")[2] == ".jpg"
    status, content, ext = images.normalize(whole(".bmp", b"xyz"), ".bmp")
    assert (status, ext) == ("kept", ".png") and content == whole(".png", b"xyz")
    assert images.normalize(whole(".bmp")[:60], ".bmp")[0] == "unreadable"
    damaged = bytearray(whole(".png"))
    damaged[40] ^= 1
    assert images.normalize(bytes(damaged), ".png")[0] == "unreadable"
    assert images.normalize(b"<svg", ".svg")[0] in ("unsupported", "unreadable")


def test_resources(spark):
    given = [("A.png", whole(".png")), ("b/a.JPEG", whole(".jpg")), ("a.PNG", whole(".png", b"2")), ("c.jpg", whole(".jpg")), ("d.tif", b"II*"), ("e", b"4"), ("f.bmp", whole(".bmp", b"2")), ("g.gif", b"?"), ("h.jpg", whole(".jpg", b"1")), ("h.jpg", whole(".jpg", b"2"))]
    files = spark.createDataFrame([(n, bytearray(c), min(i, 8)) for i, (n, c) in enumerate(given)], "name string, content binary, scan_pos long")
    found = resources.catalog(files)
    rows = {r["path"]: r for r in found.collect()}
    assert len(rows) == found.count() == 8 and bytes(rows["a.png"]["content"]) == whole(".png", b"2")
    mapped = {r["path"]: r["output"] for r in resources.resource_map(found).collect()}
    assert set(mapped) == {"a.png", "b/a.jpeg", "c.jpg", "f.bmp", "h.jpg"} and mapped["b/a.jpeg"] == mapped["c.jpg"] != mapped["a.png"] == mapped["f.bmp"]
    assert resources.blobs(found).count() == 3
    assert {r["name"]: r["n"] for r in resources.counters(found, files).collect()} == {"resources": 10, "image_resources": 5, "deduplicated_resources": 2, "discarded_non_image_resources": 1, "unreadable_resources": 1, "unsupported_resources": 1}
    wanted = spark.createDataFrame([("zz.png",)], "path string")
    with pytest.raises(Exception, match="missing resource"):
        resources.resolved(wanted, resources.resource_map(found)).collect()
    assert {r["ext"]: r["n"] for r in resources.extension_counts(found).collect()}["<none>"] == 1


@pytest.mark.parametrize("kind", ["k", "string(k)", "struct(k % 7 as a, string(k) as b)", "date_from_unix_date(cast(k as int))"])
def test_numbering_without_one_partition(spark, kind):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).selectExpr(f"{kind} as k").repartition(7)
    got = emit.global_row_number(rows, ("k",)).collect()
    want = sorted(r["k"] for r in rows.collect())
    assert [r["k"] for r in sorted(got, key=lambda r: r["place"])] == want and sorted(r["place"] for r in got) == list(range(1, 1001))


def test_numbering_of_ties(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "same").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = emit.global_row_number(rows, ("k",)).collect()
    assert sorted(r["place"] for r in got) == list(range(1, 3001)) and {r["place"] for r in got if r["k"] == "same"} == set(range(1001, 3001))
    assert emit.global_row_number(rows.where("false"), ("k",)).count() == 0


def test_more_than_a_thousand_readings(spark):
    raw = "<hdc><hm><hw>傳</hw><pron>" + "/".join(f"gā{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(1400)) + "</pron></hm><item>x</item></hdc><hdc><hm><hw>z</hw></hm><item>y</item></hdc>"
    rows = build.build(spark.createDataFrame([(1, "傳", raw)], "ordinal long, headword string, raw string")).terms.orderBy("place").collect()
    assert len(rows) > 1000 and [r["expression"] for r in rows] == ["傳"] * (len(rows) - 1) + ["z"]


def test_samples_are_bounded(spark):
    rows = spark.range(40).select(F.lit("r").alias("reason"), F.col("id").alias("ordinal"))
    assert stats.first_of_group(rows, ["reason"], ["ordinal"]).count() == 25
    assert stats.count_by(rows, "reason").first()["n"] == 40


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "ordinal long, headword string, raw string")
    assert build.build(empty).terms.count() == 0


def test_malformed_records(spark):
    rows = spark.createDataFrame([(1, "h", "a<b>c</b><![foo]]>"), (2, "g", "<hdc><item>x</item></hdc>")], "ordinal long, headword string, raw string")
    run = build.build(rows)
    got = {r["expression"]: json.loads(r["glossary"]) for r in run.terms.collect()}
    assert got["h"] == [{"type": "text", "text": "ac"}] and got["g"][0]["type"] == "structured-content"
    assert {r["name"]: r["n"] for r in build.statistics(run).collect()}["malformed_records"] == 1
    with pytest.raises(Exception, match="malformed markup: h"):
        build.build(rows, edition_="light").terms.count()


def rendered(node, light):
    """Structured content of a node, plainly by recursion; unknown tags unwrap."""
    if isinstance(node, str):
        return [unicodedata.normalize("NFC", node)] if node else []
    inner = []
    for c in node.children:
        for x in rendered(c, light):
            if isinstance(x, str) and inner and isinstance(inner[-1], str):
                inner[-1] += x
            else:
                inner.append(x)
    data, tag = {"content": inner} if inner else {}, node.tag
    if tag == "br":
        return [{"tag": "br"}]
    if tag in M.INLINE and tag != "quote":
        return [{"tag": "span", **data, "data": {"content": M.INLINE[tag]}, **({"style": M.STYLES[tag]} if tag in M.STYLES else {})}]
    if tag in M.BLOCK:
        return [{"tag": "div", **data, "data": {"content": M.BLOCK[tag]}}]
    return [{"tag": tag, **data}] if tag in M.SAME else inner


def test_pages_match_a_plain_renderer(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(F.col("page_id").alias("ordinal"), F.col("url").alias("headword"), F.col("html").alias("raw"))
    got = {r["sequence"]: json.loads(r["glossary"])[0]["content"]["content"] for r in build.build(pages).terms.collect()}
    for r in pages.collect():
        root = M.tree(r["raw"])
        want = [x for c in root.children if isinstance(c, M.Node) for x in rendered(c, False)]
        joined = []
        for x in want:
            joined[-1:] = [joined[-1] + x] if joined and isinstance(x, str) and isinstance(joined[-1], str) else [*joined[-1:], x]
        assert got[r["ordinal"]][-1] == {"tag": "div", "content": joined, "data": {"content": "generic-content"}}


def test_bad_banks_are_errors(spark, tmp_path):
    path = str(tmp_path / "b.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name, text in (("term_bank_1.json", json.dumps([GOOD, GOOD])), ("term_bank_2.json", "{not json"), ("term_bank_10.json", "{}"), ("term_bank_3.json", "[]"), ("index.json", "[]")):
            z.writestr(name, text)
    result = validate.validate_bundle(spark, path)
    assert {"term_bank_2.json: bank_not_json", "term_bank_10.json: bank_not_array", "index.json: index_not_object", "styles.css: missing_file"} <= set(result["errors"])
    assert (result["term_banks"], result["terms"], result["structured_glossaries"], result["language_roots"], result["nested_lang_attributes"]) == (4, 2, 2, 2, 0)
    assert result["schema_validated_banks"] == [1, 3]


def test_schema_keywords():
    s = Schema({"definitions": {"n": {"type": "array", "items": [{"$ref": "#/definitions/n"}, {"enum": ["a", 1]}], "additionalItems": False}}, "$ref": "#/definitions/n"})
    assert list(s.faults([[], "a"])) == [] and list(s.faults([[1], "b", 2])) == [((0, 0), "type"), ((1,), "enum"), ((2,), "false")]
    rule = {"type": "object", "required": ["t"], "properties": {"t": {"const": 1}, "p": {"pattern": "^x", "maxLength": 2}, "n": {"type": ["number", "null"], "minimum": 0, "maximum": 5}}, "additionalProperties": {"type": "boolean"}, "dependencies": {"p": ["n"]}, "anyOf": [{"required": ["t"]}, {"required": ["q"]}]}
    faults = lambda v: sorted(k for _, k in Schema(rule).faults(v))
    assert faults({"t": 1, "x": True}) == [] and faults({"t": True}) == ["const"]
    assert faults({"p": "abc", "x": 0}) == ["anyOf", "dependencies", "maxLength", "pattern", "required", "type"]
    assert faults({"t": 1, "n": 9}) == ["maximum"] and faults({"t": 1, "n": None}) == []
    assert list(Schema({"oneOf": [{"type": "integer"}, {"minimum": 2}]}).faults(3)) == [((), "oneOf")] and list(Schema({"not": {"type": "string"}}).faults("")) == [((), "not")]
    with pytest.raises(ValueError, match="another schema"):
        list(Schema({"$ref": "x.json"}).faults(1))


@pytest.mark.parametrize("options", [{}, {"encoding": "UTF-16"}, {"wide": False}, {"deflate": False, "record_block": 7}])
def test_containers(spark, tmp_path, options):
    rows = [(f"k\u00e9{i:03}" if i % 3 else f"漢{i}", f"r{i}\x00".encode() * (i % 5)) for i in range(257)]
    path = tmp_path / "words.mdx"
    path.write_bytes(containers.build(rows, per_block=20, **options))
    got = container.read(spark, str(path), entries_per_partition=50)
    assert got.rdd.getNumPartitions() > 3
    assert [(r["ordinal"], r["key"], bytes(r["value"])) for r in got.orderBy("ordinal").collect()] == [(i + 1, k, v) for i, (k, v) in enumerate(rows)]
    assert container.attributes(str(path))["entries"] == "257"
    with pytest.raises(Exception, match="not a keyed container|damaged|too early"):
        path.write_bytes(b"\0\0\0\4abcd1234")
        container.attributes(str(path))


def test_empty_and_refused_containers(spark, tmp_path):
    path = tmp_path / "e.mdx"
    path.write_bytes(containers.build([]))
    assert container.read(spark, str(path)).count() == 0
    path.write_bytes(containers.build([("a", b"b")], Encrypted="2"))
    with pytest.raises(ValueError, match="scrambled"):
        container.attributes(str(path))


def test_discovery(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        records.discover(str(tmp_path / "no"))
    with pytest.raises(ValueError, match="one file of records"):
        records.discover(str(tmp_path))
    (tmp_path / "a.mdx").write_bytes(containers.build([("e\u0301", "x\x00".encode()), ("b", b"@@@LINK=\xc3\xa9\r\n\x00")]))
    with pytest.raises(ValueError, match="resources"):
        records.discover(str(tmp_path))
    for name in ("z.mdd", "b.mdd"):
        (tmp_path / name).write_bytes(containers.build([(f"\\\\{name}\\\\P.png", b"1")], encoding="UTF-16"))
    (tmp_path / "s.css").write_text("x")
    found = records.discover(str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in (found.main, *found.resources, *found.styles)] == ["a.mdx", "b.mdd", "z.mdd", "s.css"]
    assert [tuple(r) for r in records.read_records(spark, found.main).orderBy("ordinal").collect()] == [(1, "é", "x"), (2, "b", "@@@LINK=é\r\n")]
    assert [r["name"] for r in records.read_resources(spark, *found.resources).orderBy("scan_pos").collect()] == ["\\\\b.mdd\\\\P.png", "\\\\z.mdd\\\\P.png"]
    told = records.described(spark, found)
    assert [f["name"] for f in told["files"]] == ["a.mdx", "b.mdd", "z.mdd", "s.css"] and told["container"]["entries"] == "2"
    (tmp_path / "b.mdx").write_bytes(b"")
    with pytest.raises(ValueError, match="found 2"):
        records.discover(str(tmp_path))


def test_records_without_ordinals_are_numbered(spark, tmp_path):
    spark.createDataFrame([("b", "1"), ("a", "2"), ("a", "1")], "headword string, raw string").write.parquet(str(tmp_path / "r"))
    assert [tuple(r) for r in records.read_records(spark, str(tmp_path / "r")).orderBy("ordinal").collect()] == [(1, "a", "1"), (2, "a", "2"), (3, "b", "1")]


def test_expected_readings(spark):
    raws = ["<pron>chuán fěnɡ/chuán fènɡ</pron>", "<pron>gā，<duyin>旧<duyin>又</duyin>读</duyin>，<duyin>b</duyin></pron>", "<pron>［xiū ㄒㄧㄡ］［…］</pron>", "<pron>［音未详。］</pron>", "<pron>yāo ?</pron>", "<pron>plain</pron>", "<pron> / </pron>", "<pron>ｅ\u2003ｋ<b>&amp;</b></pron>"]
    rows = spark.createDataFrame(list(enumerate(raws)), "ordinal long, raw string")
    got = {r["sequence"]: (r["reading"], r["readings"], r["kind"], r["told"]) for r in compare.expected_readings(rows).collect()}
    assert got == {
        0: ("chuán fěng/chuán fèng", ["chuán fěng", "chuán fèng"], None, None),
        1: ("gā，旧又读，b", ["gā"], "notes", "旧又读；b"),
        2: ("［xiū ㄒㄧㄡ］［…］", ["xiū"], "original", "［xiū ㄒㄧㄡ］［…］"),
        3: ("［音未详。］", [""], "original", "［音未详。］"),
        4: ("yāo ?", [""], "original", "yāo ?"),
        5: ("plain", ["plain"], None, None),
        6: ("/", [""], "original", "/"),
        7: ("ｅ\u2003ｋ&", ["e k&"], None, None),
    }
    both = compare.expected_readings(rows.withColumn("ordinal", F.lit(1)))
    assert compare.told_apart(both).count() == 8
    with pytest.raises(Exception, match="conflicting"):
        compare.told_apart(both.withColumn("reading", F.lit("x"))).collect()


def nested_notes(n, inside):
    return "<duyin>n" * n + inside + "</duyin>" * n


@pytest.mark.parametrize(
    ("markup", "want"),
    [
        ("a，" + nested_notes(7, "x") + "b", ("a，nnnnnnnxb", "ab", ["nnnnnnnx"])),
        ("a" + nested_notes(40, ""), ("a" + "n" * 40, "a", ["n" * 40])),
        ("a，，<duyin>1</duyin><duyin>2</duyin> , <duyin>3</duyin>", ("a，，12 , 3", "a， ", ["1", "2", "3"])),
        ("a，<b></b> <duyin c='d'>1<i>2</i></duyin>c", ("a， 12c", "ac", ["12"])),
        ("a</duyin>b<duyin>c", ("abc", "ab", ["c"])),
        ("a&lt;b&amp;lt;<duyin>&quot;</duyin>", ('a<b&lt;"', "a<b&lt;", ['"'])),
        ("", ("", "", [])),
    ],
)
def test_parts_of_a_pronunciation(spark, markup, want):
    row = spark.createDataFrame([(markup,)], "m string").select(compare.pronunciation_parts(F.col("m")).alias("p")).select("p.*").first()
    assert (row["original"], row["primary"], row["notes"]) == want
