"""Tables between the rounds of an iterative plan."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_own: list[str] = []
_apps: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir; a folder of our own only where that is unset and all is one process."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster spark.checkpoint.dir has to name a folder that all executors share")
        if not _own:
            _own.append(f"file://{tempfile.mkdtemp(prefix='glyphmill-')}")
        where = _own[0]
    return where.rstrip("/")


def _drop(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended already; the folder goes with the cluster's own clean-up
        pass


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, which goes when Python ends."""
    folder = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}-plans"
    if folder not in _apps:
        _apps.add(folder)
        atexit.register(_drop, spark, folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df into the shared folder and read it back, which ends its lineage."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_and_counted(df: DataFrame, tag: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """cut(), and aggregates over all rows that are observed while they are written, without a pass of their own.  They are
    taken in the tasks that write, of which each counts once, however often executors are lost; nulls count as 0."""
    seen = Observation(tag)
    out = cut(df.observe(seen, *(m.alias(name) for name, m in metrics.items())), tag)
    return out, {name: n or 0 for name, n in seen.get.items()}
