"""Resources: named by their content, looked up by normalized path, kept if used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import images
from glyphmill.functions import text as T
from glyphmill.operators.skew import spread_join

# Media types kept as they are, and those that need an imaging library to become PNG.
KEPT = (".png", ".jpg", ".jpeg", ".gif", ".webp")
RASTERIZED = (".bmp", ".tif", ".tiff", ".svg")


def catalog(files: DataFrame) -> DataFrame:
    """(path, scan_pos, output, content, ext, status) from (name, content, scan_pos).  status is kept (as it is, or as the
    PNG that it became), unreadable, unsupported (no library here can draw it) or discarded (no image).  A path met again
    takes the place of the earlier one: the last place of each path is found on names alone, and contents meet it by path,
    place and hash, so a path that very many files share isn't gathered in a task."""
    path = T.resource_path(F.col("name"))
    rows = files.select(path.alias("path"), T.suffix(path).alias("ext"), "content", "scan_pos")
    # One row wins for each path; should two have the same place, the one with the larger content hash.
    digest = F.sha2("content", 256)
    last = rows.groupBy("path").agg(F.max(F.struct("scan_pos", digest.alias("digest"))).alias("last")).select("path", "last.*")
    rows = rows.withColumn("digest", digest).join(last, ["path", "scan_pos", "digest"], "left_semi").dropDuplicates(["path", "scan_pos", "digest"]).drop("digest")
    image = F.col("ext").isin(*KEPT, *RASTERIZED)
    got = images.normalized(F.when(image, F.col("content")), F.when(image, F.col("ext")))
    rows = rows.withColumn("got", got)
    status = F.when(image, F.col("got.status")).otherwise("discarded")
    content = F.coalesce("got.content", "content")
    output = F.when(F.col("got.status") == "kept", T.content_name(content, F.col("got.ext")))
    return rows.select("path", "scan_pos", "ext", content.alias("content"), status.alias("status"), output.alias("output"))


def counters(found: DataFrame, scanned: DataFrame) -> DataFrame:
    """(name, n) of what was scanned and what became of it; equal images count as deduplicated but for the first."""
    total = scanned.agg(F.count(F.lit(1)).alias("n")).select(F.lit("resources").alias("name"), "n")
    kept = found.where("status = 'kept'").agg(F.count(F.lit(1)).alias("image_resources"), (F.count(F.lit(1)) - F.count_distinct("output")).alias("deduplicated_resources"))
    rest = found.agg(*(F.count_if(F.col("status") == s).alias(n) for s, n in (("discarded", "discarded_non_image_resources"), ("unreadable", "unreadable_resources"), ("unsupported", "unsupported_resources"))))
    unpivoted = lambda df: df.unpivot([], df.columns, "name", "n")
    return total.union(unpivoted(kept)).union(unpivoted(rest))


def resource_map(found: DataFrame) -> DataFrame:
    return found.where("output is not null").select("path", "output")


def blobs(found: DataFrame) -> DataFrame:
    """(output, content), equal files once."""
    return found.where("output is not null").groupBy("output").agg(F.any_value("content").alias("content"))


def extension_counts(found: DataFrame) -> DataFrame:
    return found.groupBy(F.coalesce(F.nullif("ext", F.lit("")), F.lit("<none>")).alias("ext")).agg(F.count(F.lit(1)).alias("n"))


def resolved(references: DataFrame, mapped: DataFrame, strict: bool = True) -> DataFrame:
    """references (path, …) with output; a miss fails the query if strict, else output is null."""
    met = spread_join(references, mapped, "path", "left")
    if strict:
        missing = F.raise_error(F.concat(F.lit("missing resource: "), F.col("path"))).cast("string")
        met = met.withColumn("output", F.when(F.col("output").isNull(), missing).otherwise(F.col("output")))
    return met


def used_blobs(found: DataFrame, references: DataFrame) -> DataFrame:
    return blobs(found).join(references.select("output").distinct(), "output", "left_semi")


def missing(referenced: DataFrame, packaged: DataFrame, name: str = "name") -> DataFrame:
    return referenced.select(name).distinct().join(packaged.select(name), name, "left_anti")


def unused(packaged: DataFrame, referenced: DataFrame, name: str = "name", most: int = 100) -> DataFrame:
    """The first `most` packaged media files that nothing refers to."""
    rows = packaged.where(F.col(name).startswith("media/")).select(name).distinct()
    return rows.join(referenced.select(name), name, "left_anti").orderBy(name).limit(most)
