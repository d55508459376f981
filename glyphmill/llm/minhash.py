"""Near-duplicate documents by MinHash bands, odd sketches and an exact check.

A document's set is its distinct five-word shingles.  Documents with equal sets form a class (told by a 64-bit hash of
the sorted set), and only classes are compared:

1. SAMPLES MinHash values a class are cut into BANDS bands of ROWS values; classes that share a band are candidates.
   At a similarity of 0.75 all bands differ with probability (1 - 0.75**5)**40 < 3e-5.
2. The samples are also folded into an odd sketch: a bitmap of BITS parities.  For two sketches that differ in x bits
   the similarity is about 1 + BITS / (4 * SAMPLES) * ln(1 - 2 x / BITS); candidates under 0.55, over four standard
   deviations off the threshold, aren't looked at further.
3. What is left is confirmed on the full sets.

A crowded band isn't expanded into all pairs.  Its members are first compared with its smallest member only.  Where that
leaves more than FEW members in different components, those are compared with the member that shares most of the crowded
bands: the text that a group was copied from shares more of them than the copies do with each other.  Only the members of
a band that are still in different components then are compared with each other, so a group of copies costs a multiple of
its size.  Bands with more than FEW of them are compared in blocks, which are as many as keep a block within BLOCK members
and ITEMS shingles: sketches alone first, then the blocks anew with the members that a sketch left and their full sets,
and only links that join something leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, hashed_words, mix, parts, powers, table
from glyphmill.llm.graph import components

WORDS, ROWS, BANDS, BITS, PERCENT = 5, 5, 40, 512, 75
SAMPLES = ROWS * BANDS
#: Sketches that differ in more bits than this estimate a similarity under 0.55.
MOST_BITS = int(BITS / 2 * (1 - np.exp((0.55 - 1) * 4 * SAMPLES / BITS)))
#: Members of a band that are paired by a join; more are compared in blocks of about BLOCK, whose sets hold about ITEMS.
FEW, BLOCK, ITEMS = 12, 1000, 2_000_000

_STEP = powers(0xD6E8FEB86659FD93, WORDS + 1)[1:]
_MULT = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BAND = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_CHUNK = 1 << 15


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text; the whole word sequence where it is shorter."""
    parts = [t.encode("utf-8", "replace").lower() if isinstance(t, str) else b"" for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    starts, _, words = hashed_words(data)
    edge = np.searchsorted(starts, np.cumsum([0] + [len(p) + 1 for p in parts]))
    n = len(words) - WORDS + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(WORDS):
        rolled += words[k : k + len(rolled)] * _STEP[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            out.append(mix((words[a:b] * _STEP[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """SAMPLES smallest values of each (non-empty) set."""
    out = np.full((len(sets), SAMPLES), np.iinfo(np.uint64).max, np.uint64)
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    for at in range(0, len(flat), _CHUNK):
        part, own = flat[at : at + _CHUNK], owner[at : at + _CHUNK]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        who = own[first]
        for j in range(SAMPLES):
            out[who, j] = np.minimum(out[who, j], np.minimum.reduceat(part * _MULT[j], first))
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps as BITS / 64 words a row."""
    bit = (mix(samples ^ _MULT) % np.uint64(BITS)).astype(np.int64)
    ones = np.bincount((np.arange(len(samples))[:, None] * BITS + bit).ravel(), minlength=len(samples) * BITS) & 1
    return np.packbits(ones.astype(np.uint8).reshape(len(samples), BITS), axis=1).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = (samples.reshape(len(samples), BANDS, ROWS) * _BAND).sum(2, dtype=np.uint64)
    return mix(rows + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _node(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, node, n, bands, odd) for each row; node null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, text):
            sets = shingle_sets(b[text].tolist())
            full = [i for i, s in enumerate(sets) if len(s)]
            node, bands, odd = np.full(len(b), None, object), np.full(len(b), None, object), np.full(len(b), None, object)
            if full:
                samples = minhash([sets[i] for i in full])
                for i, x, y in zip(full, band_keys(samples), odd_sketch(samples), strict=True):
                    node[i], bands[i], odd[i] = _node(sets[i]), x, y
            yield pd.DataFrame({key: b[key], "node": pd.Series(node, dtype="Int64"), "n": [len(s) for s in sets], "bands": bands, "odd": odd})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, node long, n long, bands array<long>, odd array<long>")


def set_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(node, items) for each row with a set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, text):
            sets = [s for s in shingle_sets(b[text].tolist()) if len(s)]
            yield pd.DataFrame({"node": [_node(s) for s in sets], "items": [s.view(np.int64) for s in sets]})

    return docs.select(key, text).mapInPandas(run, "node long, items array<long>")


def _alike(a: str, b: str) -> Column:
    """Sizes allow the threshold and the sketches agree."""
    apart = sum((F.bit_count(F.col(f"{a}.odd")[i].bitwiseXOR(F.col(f"{b}.odd")[i])) for i in range(1, BITS // 64)), F.bit_count(F.col(f"{a}.odd")[0].bitwiseXOR(F.col(f"{b}.odd")[0])))
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (small * 100 >= large * PERCENT) & (apart <= MOST_BITS)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full sets meet the threshold."""
    u, v = sets.select(F.col("node").alias("u"), F.col("items").alias("a")), sets.select(F.col("node").alias("v"), F.col("items").alias("b"))
    met = F.size(F.array_intersect("a", "b"))
    both = pairs.join(u, "u").join(v, "v").withColumn("met", met)
    return both.where(F.col("met") * 100 >= (F.size("a") + F.size("b") - F.col("met")) * PERCENT).select("u", "v")


def _alike_sets(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets meet the threshold."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    met = int((large[at] == small).sum())
    return met * 100 >= (len(a) + len(b) - met) * PERCENT


def _candidates(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs of rows within one block pair of a crowded band that sizes and sketches let pass: a row and those it may be
    like, the nearest first.  Rows of one component aren't paired, and a pair that shares several bands is looked at in
    the first of them only."""
    side, n, comp = (rows[c].to_numpy() for c in ("side", "n", "comp"))
    odd, bands = np.stack(rows["odd"]).view(np.uint64), np.stack(rows["bands"])
    here = int(np.flatnonzero(bands[0] == rows["band"].iloc[0])[0])
    right = np.flatnonzero(side > 0)
    for i in np.flatnonzero(side < 2):
        j = right[(comp[right] != comp[i]) & (np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * PERCENT)]
        apart = np.bitwise_count(odd[j] ^ odd[i]).sum(1)
        near = apart <= MOST_BITS
        j, apart = j[near], apart[near]
        j = j[np.argsort(apart, kind="stable")]
        j = j[(bands[j] == bands[i]).argmax(1) == here]
        if len(j):
            yield i, j


def _block_survivors(rows: pd.DataFrame) -> pd.DataFrame:
    """The members of a block pair that have a candidate there."""
    met = np.zeros(len(rows), bool)
    for i, j in _candidates(rows):
        met[i] = True
        met[j] = True
    return rows.loc[met, ["band", "i", "j", "side", "node", "comp"]]


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links within one block pair, confirmed on the full sets: as many as it takes to join what belongs together (a
    forest), so their number is below that of the members."""
    node, comp = rows["node"].to_numpy(), rows["comp"].to_numpy()
    sets = [np.asarray(x) for x in rows["items"]]
    up = {c: c for c in comp.tolist()}

    def top(c: int) -> int:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    found = []
    for i, js in _candidates(rows):
        for k in js:
            a, b = top(comp[i]), top(comp[k])
            if a != b and _alike_sets(sets[i], sets[k]):
                up[a] = b
                found.append((min(node[i], node[k]), max(node[i], node[k])))
    return pd.DataFrame(found, columns=["u", "v"], dtype="int64")


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(band, node, comp, size) of the bands whose members are in different components."""
    placed = members.join(comps, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    split = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
    return cut(placed.join(split.select("band", "size"), "band"), "open")


def _by_node(rows: DataFrame, *at: str) -> DataFrame:
    """(node, comp, at) with one row a node: where it stands, so that facts are joined to it once and not once a band."""
    return rows.groupBy("node", "comp").agg(F.collect_list(F.struct(*at)).alias("at"))


def links(sigs: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """Components (node, comp) of all links between members (band, node, least) of the same band."""
    facts = sigs.select("node", "n", "odd")
    u, v = facts.withColumnRenamed("node", "u").alias("x"), facts.withColumnRenamed("node", "v").alias("y")

    def alike(pairs: DataFrame) -> DataFrame:
        return pairs.join(u, "u").join(v, "v").where(_alike("x", "y")).select("u", "v")

    star = members.where("node <> least").select(F.col("least").alias("u"), F.col("node").alias("v")).distinct()
    edges = cut(_confirmed(alike(star), sets), "links")
    comps = components(edges)
    members = members.select("band", "node")
    open_ = _open(members, comps)
    crowded = open_.where(F.col("size") > FEW)
    if not crowded.isEmpty():
        by_node = _by_node(crowded, "band")
        hubs = by_node.select(F.explode("at.band").alias("band"), F.struct(F.size("at").alias("degree"), "node", "comp").alias("hub")).groupBy("band").agg(F.max("hub").alias("hub"))
        pairs = crowded.join(hubs, "band").where("comp <> hub.comp").select(F.least("node", "hub.node").alias("u"), F.greatest("node", "hub.node").alias("v")).distinct()
        edges = cut(edges.union(_confirmed(alike(pairs), sets)).distinct(), "links")
        comps = components(edges)
        open_ = _open(open_.select("band", "node"), comps)

    few = open_.where(F.col("size") <= FEW)
    a, b = few.select("band", F.col("node").alias("u"), F.col("comp").alias("cu")), few.select("band", F.col("node").alias("v"), F.col("comp").alias("cv"))
    cross = a.join(b, "band").where("u < v and cu <> cv").select("u", "v").distinct()
    # Crowded bands: each member goes to the block pairs of its block; side 1 stands for both sides of a block with itself.
    many = _by_node(open_.where(F.col("size") > FEW), "band").join(sigs, "node").select(F.explode("at.band").alias("band"), "node", "comp", "n", "odd", "bands")
    blocks = many.groupBy("band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / ITEMS)).cast("int").alias("k"))
    many = many.join(blocks, "band").withColumn("own", F.pmod(F.xxhash64("node"), "k").cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    side = F.when(F.col("own") == F.col("other"), 1).when(F.col("own") < F.col("other"), 0).otherwise(2)
    many = many.select("band", "node", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "n", "odd", "bands")
    left = many.groupBy("band", "i", "j").applyInPandas(_block_survivors, "band long, i int, j int, side int, node long, comp long")
    left = _by_node(cut(left, "survivors"), "band", "i", "j", "side").join(sigs, "node").join(sets, "node").select(F.explode("at").alias("at"), "node", "comp", "n", "odd", "bands", "items")
    left = left.select("at.*", "node", "comp", "n", "odd", "bands", "items")
    blocks = left.groupBy("band", "i", "j").applyInPandas(_block_links, "u long, v long")
    more = cut(_confirmed(alike(cross), sets).union(blocks).distinct(), "links")
    return components(edges.union(more)) if not more.isEmpty() else comps


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of docs.

    Rows with the same set are linked whatever their ids; a row without words or with a null text is linked with
    nothing and is its own component.  component_id is the smallest key reachable, null keys aside; a row with a null
    key gets the component of its set, and is kept only if that component has no other key.  Repeated rows are each
    returned, and all of them are kept or not alike.  Texts that only rows without a key have are linked like others.  Extra columns play no part.
    """
    docs = docs.select(key, text)
    found = cut(signatures(docs, key, text), "signatures")
    nodes = cut(found.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(key).alias("rep")), "nodes")
    reps = nodes.where(F.col("rep").isNotNull()).select(F.col("rep").alias(key)).distinct()
    # Two texts under one id both pass here; they differ in node, by which everything goes from here on.  So do sets that
    # rows without an id have alone.
    full = found.where(F.col("node").isNotNull())
    alone = nodes.where(F.col("rep").isNull()).select("node")
    chosen = full.join(reps, key, "left_semi").unionByName(full.where(F.col(key).isNull()).join(alone, "node", "left_semi"))
    sigs = cut(chosen.select("node", "n", "bands", "odd").dropDuplicates(["node"]), "sigs")
    bands = sigs.select(F.explode("bands").alias("band"), "node")
    shared = bands.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    members = cut(bands.join(shared.select("band", "least"), "band"), "members")

    involved = members.select("node").distinct()
    wanted = nodes.join(involved, "node", "left_semi")
    texts = docs.join(wanted.where(F.col("rep").isNotNull()).select(F.col("rep").alias(key)).distinct(), key, "left_semi")
    if not wanted.where(F.col("rep").isNull()).isEmpty():
        texts = texts.unionByName(docs.where(F.col(key).isNull()))
    sets = cut(set_table(texts, key, text).join(involved, "node", "left_semi").dropDuplicates(["node"]), "sets")
    comps = links(sigs, sets, members)

    placed = nodes.join(comps, "node", "left").select("node", "rep", F.coalesce("comp", "node").alias("comp"))
    least = placed.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_node = placed.join(least, "comp").select("node", "component_id")
    out = found.select(key, "node", F.col("n").alias("n_shingles")).join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return out.select(key, "n_shingles", component.alias("component_id")).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def op5_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op5_minhash_odd_sketch": op5_minhash_odd_sketch}
ORACLE: dict[str, str] = {}
