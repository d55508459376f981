import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import lloyd
from tests.llm import brute
from tests.llm.conftest import SF


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, code string, upper int, id string")


def padded(rows):
    return [(d, l, v, "x", 1, "i") for d, l, v in rows]


def check(spark, rows, **more):
    """The operator against all distances; rows without faults."""
    coded, books = lloyd.vector_codes(frame(spark, padded(rows)), **more)
    want, plain = brute.lloyd([(d, l, [float(np.float32(x)) for x in v]) for d, l, v in rows], **more)
    assert books.tolist() == plain
    got = [(r["vec_id"], r["label"], bytes(r["code"]), r["error"]) for r in coded.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_roots():
    rng = np.random.default_rng(1)
    d = np.concatenate([np.arange(1000), rng.integers(0, 1 << 62, 5000), (rng.integers(0, 1 << 31, 2000) ** 2), rng.integers(1, 1 << 31, 2000) ** 2 - 1])
    low, high = lloyd.floor_root(d), lloyd.ceil_root(d)
    assert all(int(r) ** 2 <= x < (int(r) + 1) ** 2 for x, r in zip(d.tolist(), low.tolist(), strict=True))
    assert all(h == r + (r * r < x) for x, r, h in zip(d.tolist(), low.tolist(), high.tolist(), strict=True))


@pytest.mark.parametrize("scale", [3, 300, 1 << 25])
def test_bounds_hold_and_prune(scale):
    """Over moving entries: codes equal all distances, bounds hold, few distances are made; ties go to the lower index."""
    rng = np.random.default_rng(scale)
    centres = rng.integers(-scale, scale + 1, (30, 4))
    x = (centres[rng.integers(0, 30, 800)] + rng.integers(-max(1, scale // 50), max(2, scale // 50 + 1), (800, 4))).astype(np.int64)
    book = x[:40].copy()
    state, made = lloyd.first_bounds(x, book), 0
    for _ in range(6):
        sums, counts = np.zeros_like(book), np.bincount(state.code, minlength=40)
        np.add.at(sums, state.code, x)
        new = lloyd.next_book(book, sums, counts)
        state, n = lloyd.moved_bounds(state, x, new, lloyd.ceil_root(((new - book) ** 2).sum(1)))
        book, made = new, made + n
        true = ((x[:, None] - book) ** 2).sum(2)
        assert (state.code == true.argmin(1)).all()
        assert (state.upper.astype(object) ** 2 >= true[np.arange(800), state.code]).all()
        assert (state.lower.astype(object) ** 2 <= true).all()
    assert made < 6 * 800 * 40 * (0.2 if scale == 300 else 1)


def test_random_rows_equal_all_distances(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(200), rng.choice([None, 1, 2]), [rng.choice([-0.5, 0.0, 0.25, rng.random()]) for _ in range(8)]) for _ in range(150)]
    check(spark, rows, entries=20)
    check(spark, [(i, 0, [i % 3 * 0.1] * 8) for i in range(40)], entries=7)  # equal entries: ties, some never used
    check(spark, [(1, 1, [9000.0, -9000.0, 1.5, 2.5]), (2, 1, [1e-4] * 4), (None, None, [0.5] * 4)], entries=2)


def test_query_equals_all_distances(spark):
    rows = [(r["vec_id"], r["label"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, books = brute.lloyd(rows, rounds=4)
    by_label = {}
    for _, l, _, e in want:
        by_label[l] = by_label.get(l, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in lloyd.op13_elkan_codes(spark, SF).collect()}
    assert got == {d: (c.hex(), e, by_label[l], digest) for d, l, c, e in want}


def test_faults_and_empty_tables(spark):
    good = [(i, i % 2 or None, [0.1 * i, 0.2, -0.3 * i, 1.0]) for i in range(9)]
    bad = [(20, 1, None), (21, 1, [0.1, None, 0.2, 0.3]), (22, 1, [float("nan"), 0.0, 0.0, 0.0]), (23, 1, [float("-inf")] * 4), (24, 1, [1.0] * 5), (25, 1, []), (26, 1, [1e30] * 4)]
    df = frame(spark, padded(good + bad))
    coded, books = lloyd.vector_codes(df, entries=3)
    want, plain = brute.lloyd([(d, l, [float(np.float32(x)) for x in v]) for d, l, v in good], entries=3)
    assert sorted((r["vec_id"], bytes(r["code"]), r["error"]) for r in coded.collect()) == sorted((d, c, e) for d, _, c, e in want) and books.tolist() == plain
    assert lloyd.with_label_errors(lloyd.vector_codes(df.where("false"))[0]).count() == 0
    no_ids = lloyd.with_label_errors(lloyd.vector_codes(df.withColumn("vec_id", F.lit(None).cast("long")))[0]).collect()
    assert len(no_ids) == 9 and all(r["code"] is None and r["error"] is None and r["label_error"] is None for r in no_ids)
    odd = [(i, 1, [0.1 * i] * 6) for i in range(5)]  # four parts don't divide six
    assert lloyd.vector_codes(frame(spark, padded(odd)), entries=2)[1].shape == (4, 2, 2)
    text_ids = df.withColumn("vec_id", F.col("vec_id").cast("string"))
    assert {r["vec_id"] for r in lloyd.vector_codes(text_ids, entries=3)[0].collect()} == {str(i) for i in range(9)}


def test_label_errors_by_either_way(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 3, i) for i in range(90)], "vec_id long, label int, error long")
    want = sorted(map(tuple, lloyd.with_label_errors(df).collect()))
    monkeypatch.setattr(lloyd, "FEW_LABELS", 1)
    assert sorted(map(tuple, lloyd.with_label_errors(df).collect())) == want
    assert {(d % 3, e) for d, _, _, e in want} == {(k, sum(range(k, 90, 3))) for k in range(3)}
    big = spark.createDataFrame([(1, 1, 1 << 62), (2, 1, 1 << 62), (3, 2, 5)], "vec_id long, label int, error long")
    assert {r["vec_id"]: r["label_error"] for r in lloyd.with_label_errors(big).collect()} == {1: None, 2: None, 3: 5}
