"""Codes of vectors: a codebook for each part of a vector, fitted by Elkan's form of Lloyd's algorithm in integers.

Components become integers floor(1024 * x), and each vector is cut into PARTS consecutive parts.  A round assigns every
part to its codebook's nearest entry and moves each entry to the floor of its parts' mean.

Between rounds a table holds, for each vector and part, the entry, an upper bound of the distance to it and a lower bound
of the distance to every entry.  When entries have moved, the upper bound grows by what the own entry moved and each
lower bound shrinks by what that entry moved; an entry that its lower bound, or half its distance from the own entry,
puts strictly beyond the upper bound isn't looked at.  Bounds are integers: distances are rounded down to lower and up
to upper ones, as are the moves against them, so what is left out is farther for certain.  What is left is decided by
exact squared distances, ties by the lower index.  Lower bounds are kept in 16 bits; a larger one counts as 65535, which
bounds too, and costs some exact distances on vectors of that size.

Each round is a map over the table, which is written anew, and a sum of what each task added up, so no row is shuffled;
the codebooks, ENTRIES times the vectors' length, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, discard, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Labels that are sent to every task; more are joined, each dealt over SPREAD parts.
FEW_LABELS, SPREAD = 10_000, 32
_MOST = np.iinfo(np.uint16).max
#: Exact squared distances made at once.
_PAIRS = 1 << 17


def floor_root(d: np.ndarray) -> np.ndarray:
    """The square root of each integer, rounded down."""
    r = np.sqrt(d.astype(np.float64)).astype(np.int64)
    r -= r * r > d
    r += (r + 1) * (r + 1) <= d
    return r


def ceil_root(d: np.ndarray) -> np.ndarray:
    r = floor_root(d)
    return r + (r * r < d)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance of each row of a from each row of b, exactly."""
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4 * a.shape[1] * int(top) ** 2 < 1 << 53:  # floating point is exact here, and much faster
        a, b = a.astype(np.float64), b.astype(np.float64)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)


@dataclass
class Bounds:
    """Of one part of m vectors: entry (m), upper (m) and lower (m x entries) bounds of distances."""

    code: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def first_bounds(x: np.ndarray, book: np.ndarray) -> Bounds:
    d = squares(x, book)
    code = d.argmin(1)  # the first of several
    return Bounds(code, ceil_root(d[np.arange(len(x)), code]), np.minimum(floor_root(d), _MOST))


def moved_bounds(old: Bounds, x: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[Bounds, int]:
    """The bounds after entries moved by `moved` (rounded up) to book, and how many distances that took."""
    code, upper = old.code.copy(), old.upper + moved[old.code]
    lower = np.maximum(old.lower.astype(np.int64) - moved, 0)
    apart = floor_root(squares(book, book))
    np.fill_diagonal(apart, np.iinfo(np.int64).max)
    at = np.flatnonzero(apart.min(1)[code] <= 2 * upper)  # others have no entry near enough to their own

    def open_pairs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = code[rows]
        near = (lower[rows] <= upper[rows, None]) & (apart[own] <= 2 * upper[rows, None])
        return np.nonzero(near)

    at = at[np.unique(open_pairs(at)[0])]
    own = ((x[at] - book[code[at]]) ** 2).sum(1)
    upper[at], lower[at, code[at]] = ceil_root(own), floor_root(own)
    i, j = open_pairs(at)
    d = np.empty(len(i), np.int64)
    for k in range(0, len(i), _PAIRS):
        d[k : k + _PAIRS] = ((x[at[i[k : k + _PAIRS]]] - book[j[k : k + _PAIRS]]) ** 2).sum(1)
    lower[at[i], j] = floor_root(d)
    i, j, d = np.concatenate([i, np.arange(len(at))]), np.concatenate([j, code[at]]), np.concatenate([d, own])
    order = np.lexsort((j, d, i))
    best = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
    code[at], upper[at] = j[best], ceil_root(d[best])
    return Bounds(code, upper, np.minimum(lower, _MOST)), len(d)


def next_book(book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Floors of the means; entries without members stay."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], book)


def integers(rows: DataFrame) -> DataFrame:
    """rows (id, label, v) with v as integers; without vectors that are null, empty, hold null or non-finite components or
    are of another length than the most common one (ties: the shorter)."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.withColumn("v", F.col("v").cast("array<double>")).where(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").head(1)
    size = sizes[0]["size"] if sizes else 1
    most = math.isqrt((1 << 60) // size)  # so that all squares of differences add up within 64 bits
    small = F.forall("v", lambda x: F.abs(x) < most / SCALE - 1)
    rows = rows.where((F.size("v") == size) & small)
    padded = F.concat(F.transform("v", lambda x: F.floor(x * SCALE).cast("int")), F.array_repeat(F.lit(0), -size % PARTS))
    return rows.withColumn("v", padded)


def start(rows: DataFrame, entries: int) -> np.ndarray:
    """The codebooks' first entries: parts x entries x width, from the smallest ids."""
    ids = rows.where(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries)
    some = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    flat = np.array([r["v"] for r in some], np.int64).reshape(len(some), PARTS, -1) if some else np.zeros((0, PARTS, 0), np.int64)
    return flat.transpose(1, 0, 2)


def _read(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _vectors(b: pd.DataFrame) -> np.ndarray:
    """The parts of a batch: vectors x parts x width."""
    v = _read(b["v"], np.int32).astype(np.int64)
    return v.reshape(len(v), PARTS, -1)


def _bounds(b: pd.DataFrame, entries: int) -> list[Bounds]:
    code, upper = _read(b["code"], np.uint8), _read(b["upper"], np.int64)
    lower = _read(b["lower"], np.uint16).reshape(len(b), PARTS, entries)
    return [Bounds(code[:, p].astype(np.int64), upper[:, p], lower[:, p]) for p in range(PARTS)]


def _step(books: np.ndarray, moved: np.ndarray | None, last: bool):
    """A round's assignment over batches of the table; with last only codes and errors are told."""
    entries = books.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            if moved is None:
                x = np.stack(b["v"]).astype(np.int64).reshape(len(b), PARTS, -1)
                now = [first_bounds(x[:, p], books[p]) for p in range(PARTS)]
            else:
                x, old = _vectors(b), _bounds(b, entries)
                now = [moved_bounds(old[p], x[:, p], books[p], moved[p])[0] for p in range(PARTS)]
            code = np.stack([s.code for s in now], 1).astype(np.uint8)
            out = {"id": b["id"], "label": b["label"], "code": [c.tobytes() for c in code]}
            if last:
                nearest = np.stack([books[p][now[p].code] for p in range(PARTS)], 1)
                out["error"] = ((x - nearest) ** 2).sum((1, 2))
            else:
                out["v"] = [c.tobytes() for c in x.astype(np.int32)]
                out["upper"] = [c.tobytes() for c in np.stack([s.upper for s in now], 1)]
                out["lower"] = [c.tobytes() for c in np.stack([s.lower for s in now], 1).astype(np.uint16)]
            yield pd.DataFrame(out)

    return run


def _added_up(state: DataFrame, entries: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums (parts x entries x width) and counts (parts x entries) of the parts assigned to each entry."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((PARTS, entries, width + 1), np.int64)
        for b in batches:
            if len(b):
                x, code = _vectors(b), _read(b["code"], np.uint8)
                for p in range(PARTS):
                    np.add.at(total[p, :, :width], code[:, p], x[:, p])
                    total[p, :, width] += np.bincount(code[:, p], minlength=entries)
        slot = np.flatnonzero(total)
        yield pd.DataFrame({"slot": slot, "total": total.ravel()[slot]})

    rows = state.select("v", "code").mapInPandas(run, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total")).collect()
    total = np.zeros(PARTS * entries * (width + 1), np.int64)
    total[[r["slot"] for r in rows]] = [r["total"] for r in rows]
    total = total.reshape(PARTS, entries, width + 1)
    return total[..., :width], total[..., width]


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(key, label, code: a byte a part, error: squared distance from the coded vector) for each row that takes part, and
    the codebooks (parts x entries x width).

    Null vectors, empty ones, those with null or non-finite components, those of another length than the most common one
    and those with components beyond 2**30 / sqrt(length) / 1024 (the squares don't fit 64 bits) take no part.  A length that
    the parts don't divide is filled up with zeros.  Repeated rows count as often as they are there; where one of the
    first ids has several vectors, the smallest is its entry.  Rows with a null key are coded, but no entry starts from
    them; without any key, or without a row, there are no entries, and codes and errors are null.  entries is at most 256.
    """
    spark = vectors.sparkSession
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (key, label)}
    names = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    rows = integers(names)
    books = start(rows, min(entries, 256))
    coded = f"id {kinds[key]}, label {kinds[label]}, code binary"
    if not books.shape[1]:
        none = rows.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return none.withColumnsRenamed({"id": key, "label": label}), books
    state, moved, schema = rows, None, f"{coded}, v binary, upper binary, lower binary"
    for k in range(rounds):
        state, before = cut(state.mapInPandas(_step(books, moved, False), schema), "bounds"), state
        if k:
            discard(before)
        sums, counts = _added_up(state, *books.shape[1:])
        new = np.stack([next_book(books[p], sums[p], counts[p]) for p in range(PARTS)])
        books, moved = new, ceil_root(((new - books) ** 2).sum(2))
    out = cut(state.mapInPandas(_step(books, moved, True), f"{coded}, error long"), "codes")
    if rounds:
        discard(state)
    return out.withColumnsRenamed({"id": key, "label": label}), books


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """coded with label_error: errors added up over equal labels, nulls together; null where that doesn't fit 64 bits."""
    sums = cut(coded.groupBy(F.col(label).alias("_label")).agg(F.try_sum("error").alias("label_error")), "labels")
    if sums.count() <= FEW_LABELS:
        return coded.join(F.broadcast(sums), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
    sums = sums.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    part = F.pmod(F.xxhash64(*coded.columns), F.lit(SPREAD)).cast("int")
    both = coded.withColumn("_own", part).join(sums, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_own") == F.col("_part")))
    return both.drop("_label", "_part", "_own")


def op13_elkan_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings with their errors, by vector and by label, and a digest of the codebooks."""
    coded, books = vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = with_label_errors(coded)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds written out; distances by inner products of doubles, which are exact at this size."""
    near = """
assigned{k} AS (
    SELECT x.vec_id, x.label, x.part, x.v, min(row(x.sq - 2 * list_inner_product(x.v, b.v) + b.sq, b.entry)) AS best
    FROM parts x JOIN book{k} b USING (part) GROUP BY ALL
),"""
    step = """
means{n} AS (
    SELECT part, entry, list(m ORDER BY pos) AS v FROM (
        SELECT part, best[2] AS entry, pos, floor(sum(v[pos]) / count(*)) AS m FROM assigned{k}, unnest(range(1, len(v) + 1)) p(pos) GROUP BY ALL
    ) GROUP BY ALL
),
book{n} AS (
    SELECT part, entry, nv AS v, list_inner_product(nv, nv) AS sq FROM (
        SELECT b.part, b.entry, coalesce(m.v, b.v) AS nv FROM book{k} b LEFT JOIN means{n} m ON m.part = b.part AND m.entry = b.entry
    )
),"""
    out = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
    SELECT vec_id, label, part, pv AS v, list_inner_product(pv, pv) AS sq FROM (
        SELECT vec_id, label, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS pv FROM kept, range({PARTS}) p(part)
    )
),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept WHERE vec_id IS NOT NULL QUALIFY entry < {ENTRIES}),
book0 AS (SELECT part, entry, v, sq FROM parts JOIN firsts USING (vec_id)),"""
    for k in range(ROUNDS):
        out += near.format(k=k) + step.format(k=k, n=k + 1)
    out += near.format(k=ROUNDS)
    return out + f"""
digest AS (
    SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
    FROM (SELECT part, entry, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM book{ROUNDS})
),
coded AS (
    SELECT vec_id, label, string_agg(lower(printf('%02x', best[2]::BIGINT)), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM assigned{ROUNDS} GROUP BY ALL
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""


QUERIES = {"op13_elkan_codes": op13_elkan_codes}
ORACLE: dict[str, str] = {"op13_elkan_codes": _sql()}
