import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.llm import graph, minhash, passages, suffix, winnow
from tests.llm import brute
from tests.llm.conftest import ODD, SF


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_near_duplicates_match_brute_force(spark, texts):
    got = by_id(minhash.op5_minhash_odd_sketch(spark, SF), "n_shingles", "component_id")
    assert got == brute.near(texts)


def test_near_duplicates_of_odd_rows(odd, none):
    got = by_id(minhash.near_duplicates(odd), "n_shingles", "component_id")
    assert got == brute.near(ODD)
    assert got[3] == (0, 3) and got[7] == (1, 6)
    assert minhash.near_duplicates(none).count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "q")], "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(rows).collect()]
    assert sorted(got, key=str) == [(5, 5, True), (5, 5, True), (None, 5, False), (None, None, True)]


def test_rows_without_ids_are_linked(spark):
    """A text that only null ids have is like another one: its row goes where the other has an id, and stays with its like
    where none has."""
    words = [f"w{i}" for i in range(60)]
    like, other = [*words[:59], "x"], [f"v{i}" for i in range(60)]
    rows = [(None, " ".join(words)), (5, " ".join(like)), (None, " ".join(other)), (None, " ".join([*other[:59], "y"])), (7, "q r s")]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == [(5, 56, 5, True), (7, 1, 7, True), (None, 56, 5, False), (None, 56, None, True), (None, 56, None, True)]


def test_blocks_carry_sets_of_survivors_only(spark, monkeypatch):
    """Of a crowded band of unlike texts no set leaves its table; blocks are cut by shingles, too."""
    monkeypatch.setattr(minhash, "FEW", 2)
    monkeypatch.setattr(minhash, "ITEMS", 300)
    rng = np.random.default_rng(3)
    rows = chain(40) + [(100 + i, " ".join(f"u{x}" for x in rng.integers(0, 1 << 30, 50))) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(minhash.near_duplicates(frame), "n_shingles", "component_id") == brute.near(rows)
    some = minhash.signatures(frame, "doc_id", "text").where("doc_id >= 100").toPandas()
    bands = some["bands"].iloc[0][0]
    block = some.assign(band=bands, i=0, j=0, side=1, comp=some["node"], bands=[np.concatenate([[bands], b[1:]]) for b in some["bands"]], node=some["node"].astype("int64"))
    assert len(minhash._block_survivors(block)) == 0


def chain(n, words=60, step=4):
    """Texts of which each is like the next only."""
    return [(i, " ".join(f"w{j}" for j in range(i * step, i * step + words))) for i in range(n)]


def test_crowded_bands_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", 2)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rows = chain(60)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(minhash.near_duplicates(frame), "n_shingles", "component_id") == brute.near(rows)


def test_copies_of_one_text_that_are_not_like_each_other(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", 2)
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(400)]

    def copy():
        at = rng.choice(400, 14, replace=False)  # about 65 of 396 shingles change: 0.83 like the base, 0.7 like each other
        return " ".join("x" + str(rng.integers(1 << 30)) if i in at else w for i, w in enumerate(base))

    rows = [(i, copy()) for i in range(40)]
    rows[23] = (23, " ".join(base))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(minhash.near_duplicates(frame), "n_shingles", "component_id") == brute.near(rows)


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for shared in (0.6, 0.75, 0.9):
        k = int(2000 * 2 * shared / (1 + shared))
        a, b = items[:2000], items[2000 - k : 4000 - k]
        x = minhash.odd_sketch(minhash.minhash([np.sort(a), np.sort(b)])).view(np.uint64)
        apart = int(np.bitwise_count(x[0] ^ x[1]).sum())
        guess = 1 + minhash.BITS / (4 * minhash.SAMPLES) * np.log(1 - 2 * apart / minhash.BITS)
        assert abs(guess - shared) < 0.12


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(40)] + [(7, 7)]
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 141))


def test_substrings_match_brute_force(spark, texts):
    got = by_id(suffix.op6_suffix_dedup(spark, SF), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {d: (*x[:3], brute.sha(x[3])) for d, x in brute.substrings(texts).items()}


def test_substrings_of_odd_rows(odd, none):
    got = {d: (*x[:3], bytes(x[3])) for d, x in by_id(suffix.dedup_substrings(odd), "n_bytes", "n_removed", "n_spans", "kept").items()}
    assert got == brute.substrings(ODD)
    assert suffix.dedup_substrings(none).count() == 0


def test_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CROWD", 5)
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(map(chr, rng.integers(97, 105, n)))
    common = letters(150)
    rows = [(i, letters(130) + common[: 110 + i] + letters(130)) for i in range(30)]
    got = by_id(suffix.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")), "n_bytes", "n_removed", "n_spans")
    assert got == {d: x[:3] for d, x in brute.substrings(rows).items()}


def test_repeated_ids_take_nothing_from_each_other(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, words), (1, words + " x"), (None, "k")], "doc_id long, text string")
    assert suffix.dedup_substrings(rows).agg({"n_removed": "sum"}).first()[0] == 0
    assert passages.dedup_passages(rows).agg({"n_removed": "sum"}).first()[0] == 0


@pytest.mark.parametrize("crowd", [3, 8000])
def test_repeated_rows_match_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = np.random.default_rng(6)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    common, other = letters(160), letters(130)
    rows = [(5, x) for x in [letters(80) + common[:60] + letters(200)] * 2] + [(6, letters(50) + common[:60] + letters(90))]
    for _ in range(25):
        x = "".join([letters(40), common[: rng.integers(50, 160)], letters(5), other, *[common] * int(rng.integers(0, 3))][int(rng.integers(0, 3)) :])
        rows += [(int(rng.integers(0, 8)), x)] * int(rng.integers(1, 4))
    got = suffix.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
    assert sorted(map(tuple, got)) == sorted((d, len(t), *x) for (d, t), x in zip(rows, brute.substrings_of_rows(rows), strict=True))


def test_passages_match_brute_force(spark, texts):
    got = by_id(passages.op7_passage_dedup(spark, SF), "n_words", "n_removed", "kept_sha256")
    assert got == {d: (n, k, brute.sha(x)) for d, (n, k, x) in brute.passages(texts).items()}


def test_passages_of_odd_rows(odd, none):
    assert by_id(passages.dedup_passages(odd), "n_words", "n_removed", "kept") == brute.passages(ODD)
    assert passages.dedup_passages(none).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=30, max_size=80), st.integers(2, 12))
def test_equal_windows_have_equal_anchors(values, w):
    grams = np.array(values, np.uint64)
    at = set(winnow.anchors(grams, w).tolist())
    for i in range(len(values) - w + 1):
        inside = [j - i for j in range(i, i + w) if j in at and grams[j] == grams[i : i + w].min()]
        assert inside == [k for k in range(w) if values[i + k] == min(values[i : i + w])]


@pytest.mark.parametrize("op", [np.minimum, np.maximum])
def test_sliding(op):
    x = np.random.default_rng(1).integers(0, 100, 50)
    for w in (1, 2, 3, 7, 8, 50):
        assert winnow.sliding(x, w, op).tolist() == [int(op.reduce(x[i : i + w])) for i in range(51 - w)]


def test_ids_of_any_kind(spark, texts):
    """Ids that are text order rows as text: the earlier one keeps what both have."""
    some = [(f"d{i % 7}-{i:03}", t) for i, t in texts[:40] if t]
    rows = some + [(f"e{d}", t) for d, t in some[:5]] + [(None, "x " * 80)]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    place = {d: n for n, d in enumerate(sorted(d for d, _ in rows if d is not None))}
    want = brute.substrings([(place.get(d, -1), t) for d, t in rows])
    got = by_id(suffix.dedup_substrings(frame), "n_bytes", "n_removed", "n_spans", "kept")
    assert {place.get(d, -1): (a, b, c, bytes(k)) for d, (a, b, c, k) in got.items()} == want
    words = by_id(passages.dedup_passages(frame), "n_words", "n_removed", "kept")
    whole = {place.get(d, -1): v for d, v in words.items()}
    numbered = spark.createDataFrame([(place.get(d, -1), t) for d, t in rows], "doc_id long, text string")
    assert whole == by_id(passages.dedup_passages(numbered), "n_words", "n_removed", "kept")


def test_crowded_members_have_one_row_a_node(spark):
    from glyphmill.llm import minhash

    rows = spark.createDataFrame([(b, n, n % 2) for b in range(5) for n in range(3)], "band long, node long, comp long")
    found = {r["node"]: (r["comp"], sorted(x["band"] for x in r["at"])) for r in minhash._by_node(rows, "band").collect()}
    assert found == {n: (n % 2, list(range(5))) for n in range(3)}
