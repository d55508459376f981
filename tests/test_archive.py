import hashlib
import io
import os
import random
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from glyphmill.plans import build
from glyphmill.sources import archive, bundle, files, records


def contents(n, seed=1):
    rng = random.Random(seed)
    return {f"{'media/é' if i % 3 else 'term_bank_'}{i}{'.png' if i % 3 else '.json'}": rng.randbytes(rng.choice([0, 1, 700, 40_000])) for i in range(n)}


def frame(spark, found):
    return spark.createDataFrame(list(found.items()), "name string, content binary")


def packed(path, found, **more):
    with zipfile.ZipFile(path, "w", **more) as z:
        for name, content in found.items():
            z.writestr(name, content)


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_members_of_any_archive(spark, tmp_path, method):
    found, path = contents(60), str(tmp_path / "a.zip")
    packed(path, found, compression=method)
    got = archive.members(spark, path, bytes_per_partition=100_000)
    assert got.rdd.getNumPartitions() > 3
    rows = got.orderBy("place").collect()
    assert {r["name"]: bytes(r["content"]) for r in rows} == found and [r["name"] for r in rows] == list(found) and [r["place"] for r in rows] == list(range(60))
    assert {r["name"] for r in archive.members(spark, path, names=r"term_bank_\d+\.json").collect()} == {n for n in found if n.startswith("term")}
    with zipfile.ZipFile(path) as z:
        assert [(r["size"], r["stored"], r["crc"]) for r in rows] == [(i.file_size, i.compress_size, i.CRC) for i in z.infolist()]


class Watched(io.FileIO):
    """A file that remembers which bytes were read."""

    reads: list = []

    def read(self, n=-1):
        at = self.tell()
        out = super().read(n)
        self.reads.append((at, at + len(out)))
        return out


def test_no_task_reads_more_than_its_members(tmp_path, monkeypatch):
    found, path = contents(40, 2), str(tmp_path / "a.zip")
    packed(path, found)
    monkeypatch.setattr(archive, "opened", Watched)
    runs, reader = archive.runs(path, 60_000), archive._Reader({"path": path})
    with zipfile.ZipFile(path) as z:
        infos, begin = z.infolist(), z.start_dir
    assert len(runs) > 4 and not any(a < begin - 22 - 65_535 for a, _ in Watched.reads[:1])
    done = 0
    for run in runs:
        Watched.reads.clear()
        rows = list(reader.read(run))
        own = infos[done : done + len(rows)]
        done += len(rows)
        stops = {i.header_offset: (infos[infos.index(i) + 1].header_offset if i is not infos[-1] else begin) for i in own}
        spans = [(i.header_offset, stops[i.header_offset]) for i in own] + [(run.begin, run.end)]
        assert all(any(a <= x and y <= b for a, b in spans) for x, y in Watched.reads)
    assert done == 40
    Watched.reads.clear()
    names = [r[1] for run in runs for r in archive._Reader({"path": path, "content": "false"}).read(run)]
    assert names == list(found) and all(a >= begin for a, _ in Watched.reads)


def test_bytes_do_not_depend_on_partitions(spark, tmp_path):
    found, sums = contents(50, 3), set()
    rows = frame(spark, found)
    for n in (1, 4, 13):
        path = str(tmp_path / f"{n}.zip")
        archive.write(rows.repartition(n).orderBy(F.rand(n)) if n > 1 else rows.coalesce(1), path)
        sums.add(files.digest(path))
        with zipfile.ZipFile(path) as z:
            assert z.testzip() is None and z.namelist() == sorted(found, key=str.encode)
            assert {n: z.read(n) for n in z.namelist()} == found
            assert {(i.date_time, i.external_attr >> 16, i.compress_type) for i in z.infolist()} == {((1980, 1, 1, 0, 0, 0), 0o644, 8)}
    assert len(sums) == 1 and sorted(os.listdir(tmp_path)) == ["1.zip", "13.zip", "4.zip"]
    size, digest = sums.pop()
    with open(path, "rb") as f:
        assert digest == hashlib.sha256(f.read()).hexdigest() and size == os.path.getsize(path)
    back = archive.members(spark, path).select("name", "content").collect()
    assert {r["name"]: bytes(r["content"]) for r in back} == found


def test_write_odd_rows(spark, tmp_path):
    path = str(tmp_path / "o.zip")
    archive.write(spark.createDataFrame([("a", None), ("b", b"")], "name string, content binary"), path)
    assert {r["name"]: bytes(r["content"]) for r in archive.members(spark, path).collect()} == {"a": b"", "b": b""}
    archive.write(spark.createDataFrame([], "name string, content binary"), path)
    assert archive.members(spark, path).count() == 0 and zipfile.ZipFile(path).namelist() == []
    with pytest.raises(Exception, match="two members"):
        archive.write(spark.createDataFrame([("a", b"1"), ("a", b"2")], "name string, content binary").repartition(2), path)
    assert sorted(os.listdir(tmp_path)) == ["o.zip"]


def test_more_is_computed_once(spark, tmp_path):
    met = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            met.add(len(b))
            yield b

    rows = frame(spark, contents(20, 4)).repartition(3).mapInPandas(count, "name string, content binary")
    bundle.write_zip(str(tmp_path / "x.zip"), [("index.json", b"{}")], rows)
    assert met.value == 20


def test_long_archives_and_damage(spark, tmp_path):
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w") as z:
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"x" * 1000)
        z.writestr("n" * 300, b"y")
    raw = path.read_bytes()
    # Rewrite the end with long fields, as archives of more than 65,535 members have it.
    at = raw.rindex(b"PK\5\6")
    _, _, _, _, n, size, begin, _ = struct.unpack_from("<4s4H2IH", raw, at)
    long = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, begin) + struct.pack("<4sIQI", b"PK\6\7", 0, at, 1) + struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 4) + b"note"
    path.write_bytes(raw[:at] + long)
    assert {r["name"]: len(r["content"]) for r in archive.members(spark, str(path)).collect()} == {"big": 1000, "n" * 300: 1}
    for damage, told in ((b"", "not an archive"), (raw[:-30], "not an archive"), (raw.replace(b"xxxx", b"xxxy", 1), "damaged"), (raw.replace(b"PK\1\2", b"PK\1\3", 1), "damaged")):
        path.write_bytes(damage)
        with pytest.raises(Exception, match=told):
            archive.members(spark, str(path)).collect()


def test_more_members_than_short_fields_count(spark, tmp_path):
    path, n = str(tmp_path / "m.zip"), 70_000
    rows = spark.range(n).select(F.concat(F.lit("d/"), "id").alias("name"), F.col("id").cast("string").cast("binary").alias("content"))
    archive.write(rows.repartition(5), path)
    with zipfile.ZipFile(path) as z:
        assert z.namelist() == sorted(f"d/{i}" for i in range(n)) and z.read("d/69999") == b"69999"
    got = archive.members(spark, path, bytes_per_partition=100_000)
    assert got.rdd.getNumPartitions() > 3
    assert got.where("content <> cast(substr(name, 3) as binary)").isEmpty() and got.agg(F.count_distinct("name"), F.max("place")).first() == (n, n - 1)


def test_places_beyond_short_fields(tmp_path):
    """Entries and the end of an archive of more than 4 GB, whose members are a hole in a file."""
    path, far = str(tmp_path / "f.zip"), (5 << 30) + 7
    content = b"x" * 10
    entries = archive._entry("a".encode(), 1, 10, 10, 3) + archive._entry("é".encode(), zlib.crc32(content), 10, 10, far)
    begin = far + 100
    with open(path, "wb") as f:
        f.seek(far)
        f.write(archive._LOCAL_PART.pack(b"PK\3\4", 20, 0x800, 0, 0, 0x21, zlib.crc32(content), 10, 10, 2, 0) + "é".encode() + content)
        f.seek(begin)
        f.write(entries + archive._end(2, len(entries), begin))
    with zipfile.ZipFile(path) as z:
        assert [(i.filename, i.header_offset) for i in z.infolist()] == [("a", 3), ("é", far)]
    assert [(e.name, e.at) for e in archive._entries(entries)] == [("a", 3), ("é", far)]
    assert [(r.begin, r.end, r.place) for r in archive.runs(path, 1)] == [(begin, begin + 47, 0), (begin + 47, begin + len(entries), 1)]


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "k.zip")
    archive.write(frame(spark, {"a": b"1"}), path)
    with pytest.raises(Exception, match="two members"):
        archive.write(spark.createDataFrame([("a", b"1"), ("a", b"2")], "name string, content binary").repartition(2), path)
    assert zipfile.ZipFile(path).namelist() == ["a"] and os.listdir(tmp_path) == ["k.zip"]


def test_a_bundle_of_94_banks_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(940).select(
        F.lit("e").alias("expression"), F.lit("ā").alias("reading"), F.lit("").alias("definition_tags"), F.lit("").alias("rules"), F.lit(0).alias("score"),
        F.concat(F.lit('["'), F.sha2(F.col("id").cast("string"), 512), F.lit('"]')).alias("glossary"), F.col("id").alias("sequence"), F.lit("").alias("term_tags"), F.col("id").alias("place"), (F.floor(F.col("id") / 10) + 1).alias("bank_no"),
    )
    path = str(tmp_path / "b.zip")
    bundle.write_bundle(path, rows, bundle.index("T", "1"), "x")
    monkeypatch.setattr(records, "BANK_BYTES", 10_000)
    banks = records.scan_banks(spark, path)
    assert banks.rdd.getNumPartitions() > 4
    assert banks.where("place < 0").count() == 94 and banks.where("place >= 0").count() == 940
    assert build.EDITIONS and sorted(r["sequence"] for r in banks.where("place >= 0").selectExpr("cast(get_json_object(row, '$[6]') as long) as sequence").collect()) == list(range(940))
