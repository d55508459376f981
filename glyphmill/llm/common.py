"""What the operators of this subpackage share: tables, scratch space, stable hashes."""

from __future__ import annotations

import atexit
import re
import tempfile
import time
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions.batches import give_back, parts  # noqa: F401  the operators take them from here

#: Bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_made: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; where that is unset and all is one process, a folder of our own."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster spark.checkpoint.dir has to name a folder that all executors share")
        where = _made.setdefault("own", [f"file://{tempfile.mkdtemp(prefix='glyphmill-')}"])[0]
    return where.rstrip("/")


def _drop(spark: SparkSession, app: str, base: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{app}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended already; the folder goes with the cluster's own clean-up
        pass


def cut(df: DataFrame, tag: str, tidy: bool = False) -> DataFrame:
    """Write df as a table into the shared folder and read it back: its lineage ends, each row is computed once, and
    the loss of an executor costs nothing.  The folder of the application is removed when Python ends.  With tidy the
    driver also collects its garbage, upon which Spark deletes the shuffle files that only the lineage needed."""
    spark = df.sparkSession
    base, app = scratch_dir(spark), spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = []
        atexit.register(_drop, spark, app, base)
    path = f"{base}/{app}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if tidy:
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)  # the cleaner works on its own thread
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by cut(), once nothing to come reads it."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def is_integral(rows: DataFrame, column: str) -> bool:
    """Whether a column is of integers, which order rows as they are."""
    return rows.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")


def numbers_of(rows: DataFrame, column: str) -> DataFrame:
    """(column, _number) for each distinct value that isn't null: numbers in the order of the values, with gaps."""
    values = cut(rows.select(column).where(F.col(column).isNotNull()).distinct(), "values")
    ordered = values.repartitionByRange(column).sortWithinPartitions(column)
    return cut(ordered.select(column, F.monotonically_increasing_id().alias("_number")), "numbers")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; 0 where the id is null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)), F.lit(0))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit words that spreads all bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


_BASE, _SPACE = 0x9E3779B97F4A7C15, np.isin(np.arange(256), SPACE_BYTES)
_POW = powers(_BASE, 4096)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+` in UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    longest = int(size.max())
    pw = _POW if longest <= len(_POW) else powers(_BASE, longest)
    first, last = int(starts[0]), int(ends[-1])
    begin = np.zeros(last - first, np.int64)
    begin[starts - first] = np.diff(starts, prepend=first)
    at = np.arange(last - first) - np.cumsum(begin)
    # Blanks after a word are counted with it but add nothing.
    value = np.where(_SPACE[data[first:last]], np.uint64(0), data[first:last].astype(np.uint64) + np.uint64(1))
    if len(pw) <= int(at.max(initial=0)):
        at = np.where(value == 0, 0, at)
    return mix(np.add.reduceat(value * pw[at], starts - first) + size.astype(np.uint64))


def block_ends(data: np.ndarray, size: int = 1 << 20) -> list[int]:
    """Where to cut UTF-8 bytes into blocks of about `size` bytes: at blanks only, so no word is cut."""
    ends, at = [], 0
    while len(data) - at > size:
        end, step = at + size, 4096
        while end < len(data):
            blank = np.flatnonzero(_SPACE[data[end : end + step]])
            if len(blank):
                end += int(blank[0])
                break
            end, step = min(end + step, len(data)), step * 2
        ends.append(end)
        at = end
    return [*ends, len(data)] if not ends or ends[-1] < len(data) else ends


def hashed_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, made block by block: memory beside the result doesn't grow with data."""
    found, at = [], 0
    for end in block_ends(data):
        starts, ends = word_spans(data[at:end])
        found.append((starts + at, ends + at, word_hashes(data[at:end], starts, ends)))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
