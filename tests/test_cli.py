import json
import zipfile

import numpy as np
import pytest

from glyphmill import cli
from glyphmill.functions import images
from glyphmill.plans import build
from glyphmill.sources import records
from tests import containers

ROWS = [
    (1, "傳", "<hdc><hm><hw>傳</hw><pron>gā/?</pron></hm><item>x<img src='bres://h/A.png'><img src='a.PNG'></item></hdc>"),
    (2, "別", "@@@LINK=傳"),
    (3, "x1", "<ul><li>n</li></ul>"),
]


SCHEMA = {"index": {"type": "object", "required": ["title", "revision", "author"]}, "term-bank": {"type": "array", "items": {"type": "array", "minItems": 8, "items": [{"type": "string"}]}}}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    (root / "words.mdx").write_bytes(containers.build([(h, r.encode()) for _, h, r in ROWS]))
    (root / "more.mdd").write_bytes(containers.build([("\\\\A.png", images.png(np.zeros((1, 1, 3), np.uint8))), ("\\\\x.css", b"")], encoding="UTF-16"))
    (root / "resources" / "deep").mkdir(parents=True)
    (root / "resources" / "deep" / "b.png").write_bytes(images.png(np.zeros((1, 2, 3), np.uint8)))
    (root / "rules.json").write_text("[]")
    for name, file in cli.SCHEMAS.items():
        (root / file).write_text(json.dumps(SCHEMA[name]))
    return root


def test_build_validate_and_report(spark, folder, tmp_path, capsys, monkeypatch):
    out, report = str(tmp_path / "o.zip"), tmp_path / "r.json"
    monkeypatch.setenv(cli.REVISION, "r7")
    assert cli.main(["build", "--input", str(folder), "--output", out, "--report", str(report), "--corrections", str(folder / "rules.json"), "--url", "https://x/"]) == 0
    got = json.loads(report.read_text())
    assert got["exclusions"] == {"navigation": 1} and got["counts"]["unresolved_question_mark"] == 1 and got["revision"] == "r7"
    assert got["reading_diagnostics"]["samples"]["slash_alternatives"][0]["headword"] == "傳"
    assert got["counts"]["resources"] == 3 and got["counts"]["discarded_non_image_resources"] == 1 and got["resource_extensions"] == {".css": 1, ".png": 2}
    assert got["output"]["terms"] == got["counts"]["emitted_terms"] == 2 and got["performance"]["build_seconds"] > 0 and got["input"]["container"]["entries"] == "3"
    names = {r["name"] for r in records.read_members(spark, out).collect()}
    assert len([n for n in names if n.startswith("media/")]) == 1
    index = next(json.loads(bytes(r["content"])) for r in records.read_members(spark, out).collect() if r["name"] == "index.json")
    assert index["revision"] == "r7" and index["indexUrl"] == "https://x/index.json"
    for mode in ([], ["--exhaustive"], ["--archive-only"]):
        assert cli.main(["validate", out, *mode]) == 0
    assert "valid: true" in capsys.readouterr().out
    assert cli.main(["validate", out, "--schemas", str(folder)]) == 1
    assert "schema required at author" in capsys.readouterr().out


def test_light_has_no_media_and_full_fails_as_light(folder, tmp_path):
    light, full = str(tmp_path / "l.zip"), str(tmp_path / "f.zip")
    assert cli.main(["build", "--input", str(folder), "--output", light, "--edition", "light", "--url", "https://x"]) == 0
    assert cli.main(["build", "--input", str(folder), "--output", full]) == 0
    assert cli.main(["validate", light, "--edition", "light", "--url", "https://x"]) == 0
    assert cli.main(["validate", light, "--edition", "light", "--url", "https://y"]) == 1
    assert cli.main(["validate", full, "--edition", "light"]) == 1


def test_compare(spark, folder, tmp_path, capsys):
    new, old, same = str(tmp_path / "n.zip"), str(tmp_path / "o.zip"), str(tmp_path / "s.zip")
    assert cli.main(["build", "--input", str(folder), "--output", new]) == 0
    with zipfile.ZipFile(new) as z, zipfile.ZipFile(old, "w") as o:
        for name in z.namelist():
            text = z.read(name)
            if name.startswith("term_bank"):  # the older bundle had the pronunciation as it was, and nothing told about it
                rows = json.loads(text)
                for r in rows:
                    content = r[5][0]["content"]["content"]
                    r[1] = "gā/?"
                    del content[1]
                text = json.dumps(rows).encode()
            o.writestr(name, text)
    report = tmp_path / "c.json"
    assert cli.main(["compare", old, new, "--input", str(folder), "--report", str(report)]) == 0
    got = json.loads(report.read_text())
    assert got["counts"] == {"unchanged_assets": 2, "changed_original_rows": 2, "expanded_original_rows": 0, "expected_exact_duplicates": 0, "expected_rows": 2, "new_rows": 2, "old_rows": 2, "rows_with_retained_pronunciation": 2}
    assert cli.main(["compare", new, old, "--input", str(folder)]) == 1
    with zipfile.ZipFile(new) as z, zipfile.ZipFile(same, "w") as o:
        for name in z.namelist():
            o.writestr(name, z.read(name).replace(b"font-family", b"font"))
    capsys.readouterr()
    assert cli.main(["compare", old, same, "--input", str(folder)]) == 1
    assert json.loads(capsys.readouterr().out)["assets"] == [{"name": "styles.css", "state": "different"}]


def test_missing_images_fail(spark):
    frame = spark.createDataFrame(ROWS, "ordinal long, headword string, raw string")
    empty = spark.createDataFrame([], "name string, content binary, scan_pos long")
    with pytest.raises(Exception, match="missing resource"):
        build.build(frame, files=empty).terms.count()


def test_bad_arguments():
    with pytest.raises(SystemExit) as stop:
        cli.main(["validate", "x", "--exhaustive", "--archive-only"])
    assert stop.value.code == 2


def test_inspect(folder, capsys):
    assert cli.main(["inspect", "--input", str(folder)]) == 0
    got = json.loads(capsys.readouterr().out)
    assert [x["name"] for x in got["files"]] == ["words.mdx", "more.mdd", "b.png"] and got["container"]["entries"] == "3"
