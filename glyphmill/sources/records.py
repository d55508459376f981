"""Inputs: keyed records, resources, rule files, term banks; and what is known about the files they came from."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glyphmill.functions import text as T
from glyphmill.plans.scratch import cut, scratch_path
from glyphmill.sources import archive, container, files

RULE_SCHEMA = "source_sha256 string, headword string, before string, after string, reason string, evidence string"


#: Bytes of a file that one task digests; longer files go on from task to task.
SEGMENT = 1 << 28


def inventory(spark: SparkSession, path: str, glob: str = "*", joined: bool = False) -> DataFrame:
    """(name, size, sha256) of each file below path.  With joined (name, size, sha256) of each folder, whose files, in the
    order of their names, are the parts of one file.

    No task reads much more than SEGMENT bytes, whatever the length of a file; files that are longer, or in parts, are
    read through Arrow's file systems.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    folder, name = F.regexp_extract("path", "^(.*)/[^/]*$", 1), F.element_at(F.split("path", "/"), -1)
    listed = found.select((folder if joined else F.col("path")).alias("file"), name.alias("part"), "path", "length")
    if joined:
        return _digests(listed)
    short = found.where(F.col("length") <= SEGMENT).select(name.alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    long = listed.where(F.col("length") > SEGMENT)
    return short if long.isEmpty() else short.unionByName(_digests(long))


def _digests(parts: DataFrame) -> DataFrame:
    """(name, size, sha256) of files (file, and of each of their parts: part, path, length): a task for each file and SEGMENT
    bytes, which go on with the digest where the one before has left it."""
    spark, segment = parts.sparkSession, SEGMENT if files.RESUMABLE else 1 << 62
    start = F.sum("length").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    rows = parts.withColumn("start", start).withColumn("first", F.expr(f"start div {segment}L"))
    rows = rows.withColumn("round", F.explode(F.sequence("first", F.greatest("first", F.expr(f"(start + length - 1) div {segment}L")))))
    begin = F.greatest(F.col("round") * segment - F.col("start"), F.lit(0))
    # The difference to the part's begin in place of the next round's begin, which may pass 64 bits.
    size = F.least(F.col("length") - begin, F.lit(segment) - (F.col("start") + begin - F.col("round") * segment))
    piece = F.struct("part", F.regexp_replace("path", "^file:/+", "/").alias("path"), begin.alias("begin"), size.alias("size"))
    pieces = rows.groupBy("file", "round").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    pieces = cut(pieces.select("file", "round", "pieces.path", "pieces.begin", "pieces.size", (F.col("round") == F.max("round").over(Window.partitionBy("file"))).alias("last")), "pieces")
    counts = {r["round"]: r["n"] for r in pieces.groupBy("round").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a round

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for file, paths, begins, sizes, last, state, n in zip(b["file"], b["path"], b["begin"], b["size"], b["last"], b["state"], b["n"], strict=True):
                digest = files.Sha256(state) if files.RESUMABLE else hashlib.sha256()
                for where, begin, size in zip(paths, begins, sizes, strict=True):
                    for piece in files.ranged(where, int(begin), int(size)):
                        digest.update(piece)
                out.append((file, n + int(sum(sizes)), None if last else digest.state(), digest.hexdigest() if last else None))
            yield pd.DataFrame(out, columns=["file", "n", "state", "sha256"])

    kept, target = "file string, n long, state binary, sha256 string", scratch_path(spark, "digests")
    for k in range(len(counts)):  # a file has a piece in each round up to its last
        due = pieces.where(F.col("round") == k)
        if k:
            due = due.join(spark.read.schema(kept).parquet(f"{target}/round={k - 1}").drop("sha256"), "file")
        else:
            due = due.withColumns({"state": F.lit(None).cast("binary"), "n": F.lit(0).cast("long")})
        # Rows of one task are dealt evenly, so that each file has a task of its own.
        due.drop("round").coalesce(1).repartition(counts[k]).mapInPandas(run, kept).write.parquet(f"{target}/round={k}")
    done = spark.read.schema(kept).parquet(*(f"{target}/round={k}" for k in range(len(counts)))) if counts else spark.createDataFrame([], kept)
    return done.where("sha256 is not null").select(F.element_at(F.split("file", "/"), -1).alias("name"), F.col("n").alias("size"), "sha256")


@dataclass(frozen=True)
class Inputs:
    """What a folder holds: the one main file, resource files, stylesheets; each list by name."""

    root: str
    main: str
    resources: tuple[str, ...]
    styles: tuple[str, ...]


#: Endings of containers of records and of resources.
MAIN, RESOURCES = ".mdx", ".mdd"


def discover(root: str) -> Inputs:
    """The inputs in a folder: exactly one file of records (a container, or Parquet named records.parquet) and at least
    one of resources (containers, or a folder named resources)."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), os.path.abspath(root))
    if system.get_file_info(inside).type != fs.FileType.Directory:
        raise FileNotFoundError(f"no such folder: {root}")
    found = sorted(system.get_file_info(fs.FileSelector(inside)), key=lambda f: f.base_name)
    prefix = root.rstrip("/") if "://" in root else inside
    named = lambda want: [f"{prefix}/{f.base_name}" for f in found if want(f)]
    is_file = lambda f: f.type == fs.FileType.File
    main = named(lambda f: is_file(f) and f.base_name.endswith(MAIN) or f.base_name == "records.parquet")
    if len(main) != 1:
        raise ValueError(f"expected exactly one file of records in {root}, found {len(main)}")
    parts = named(lambda f: is_file(f) and f.base_name.endswith(RESOURCES) or not is_file(f) and f.base_name == "resources")
    if not parts:
        raise ValueError(f"expected at least one file of resources in {root}")
    return Inputs(prefix, main[0], tuple(parts), tuple(named(lambda f: is_file(f) and f.base_name.endswith(".css"))))


def described(spark: SparkSession, inputs: Inputs) -> dict:
    """The inventory of a folder's inputs, with the attributes of the container of records."""
    files = [inputs.main, *inputs.resources, *inputs.styles]
    rows = [r.asDict() for path in files for r in inventory(spark, path).orderBy("name").collect()]
    return {"root": inputs.root, "files": rows, "container": container.attributes(inputs.main) if inputs.main.endswith(MAIN) else {}}


def numbered(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """rows with ordinal, from 1 in an order: for sources that don't number their records."""
    from glyphmill.operators.emit import global_row_number

    return global_row_number(rows, order, "ordinal")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, headword, raw) from a container or from Parquet; the headword is composed but not trimmed.  Parquet
    without ordinals is numbered by headword and text."""
    if path.endswith(MAIN):
        rows = container.read(spark, path)
        text = F.decode("value", "utf-8")
        return rows.select("ordinal", T.nfc(F.col("key")).alias("headword"), F.regexp_replace(text, "\\x00+$", "").alias("raw"))
    rows = spark.read.parquet(path)
    if "ordinal" not in rows.columns:
        rows = numbered(rows.select("headword", "raw"), ("headword", "raw"))
    return rows.select(F.col("ordinal").cast("long").alias("ordinal"), T.nfc(F.col("headword")).alias("headword"), F.col("raw").cast("string").alias("raw"))


def read_resources(spark: SparkSession, *paths: str) -> DataFrame:
    """(name, content, scan_pos) from containers and folders, in their order; names keep their folders."""
    out = None
    for i, path in enumerate(paths):
        if path.endswith(RESOURCES):
            rows = container.read(spark, path).select(F.col("key").alias("name"), F.col("value").alias("content"), "ordinal")
        else:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()
            name = F.substring("path", F.lit(len(root) + 2), F.length("path"))
            rows = files.select(name.alias("name"), "content", F.xxhash64("path").bitwiseAND((1 << 40) - 1).alias("ordinal"))
        rows = rows.select("name", "content", (F.lit(i << 41) + F.col("ordinal")).alias("scan_pos"))
        out = rows if out is None else out.union(rows)
    return out


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Correction rules from a JSON array, numbered in the order of the file."""
    rows = spark.read.option("multiLine", True).schema(RULE_SCHEMA).json(path)
    return rows.withColumn("rule", F.monotonically_increasing_id())  # one file, one partition: its order


BANKS = "bank long, place long, row string, n long, fault string"
#: Stored bytes of the banks that a task reads: they grow about tenfold.
BANK_BYTES = 4 << 20
BANK_NAMES = r"term_bank_(\d+)\.json"


def bank_rows(members: DataFrame) -> DataFrame:
    """(bank, place, row, n, fault) of the term banks among members (name, content): first a row with place -1 for the bank
    itself, with its number of rows, or the fault that it isn't JSON or not an array; then its rows as JSON text."""

    def scanned(number: int, raw: bytes) -> pd.DataFrame:
        try:
            rows, fault = json.loads(raw), None
        except ValueError:
            rows, fault = None, "bank_not_json"
        if not isinstance(rows, list):
            rows, fault = [], fault or "bank_not_array"
        texts = [json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in rows]
        n = None if fault else len(rows)
        return pd.DataFrame({"bank": number, "place": range(-1, len(rows)), "row": pd.Series([None, *texts], dtype=object), "n": pd.Series([n, *[None] * len(rows)], dtype="Int64"), "fault": pd.Series([fault, *[None] * len(rows)], dtype=object)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["name"], b["content"], strict=True):
                yield scanned(int(re.fullmatch(BANK_NAMES, name)[1]), content)

    return members.where(F.col("name").rlike(f"^{BANK_NAMES}$")).select("name", "content").mapInPandas(run, BANKS)


def scan_banks(spark: SparkSession, path: str) -> DataFrame:
    """bank_rows() of archives; only the banks are read, by as many tasks as they take."""
    return bank_rows(archive.members(spark, path, names=BANK_NAMES, bytes_per_partition=BANK_BYTES))


def read_banks(spark: SparkSession, path: str) -> DataFrame:
    """(bank, place, row: JSON text of a term row) of the term banks in archives; banks that are no arrays have none."""
    return scan_banks(spark, path).where("place >= 0").select("bank", "place", "row")


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of everything in archives."""
    return archive.members(spark, path).select("name", "content")
