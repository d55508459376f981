import random

import pytest

from glyphmill.llm import variants
from tests.llm import brute


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def words_frame(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_keys_tell_what_strings_tell():
    """Beyond LONG letters keys are numbers; they have to agree with the spelled-out ones."""
    rng = random.Random(3)
    for size in (3, variants.LONG, variants.LONG + 1, variants.LONG + 2, 90):
        a = "".join(rng.choice("abcé") for _ in range(size))
        i = rng.randrange(size)
        b, c = a[:i] + "z" + a[i + 1 :], a[:i] + "z" + a[i:]
        assert len(set(variants.wildcard_keys(a)) & set(variants.wildcard_keys(b))) == 1
        assert len(set(variants.wildcard_keys(a))) == size and not set(variants.wildcard_keys(a)) & set(variants.wildcard_keys(a[1:] + "q"))
        assert variants.own_key(a) in variants.deletion_keys(c)
        assert variants.deletion_keys(a) >= {variants.own_key(a[1:]), variants.own_key(a[:-1])}
        assert len(variants.deletion_keys(a)) == len({a[:k] + a[k + 1 :] for k in range(size)})


@pytest.mark.parametrize("seed", range(3))
def test_random_words_equal_all_pairs(spark, seed):
    """Words over few letters, so that groups are full and ties frequent; some beyond LONG letters."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.choice([5, 6, 7, variants.LONG, variants.LONG + 1]))) for _ in range(40)]
    words = []
    for _ in range(1500):
        w = rng.choice(stems)
        i = rng.randrange(len(w))
        words.append(rng.choice([w, w, w[:i] + "é" + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + "a" + w[i:]]))
    got = found(variants.spelling_variants(words_frame(spark, words)))
    assert got == brute.variants([w for w in words if len(w) >= 5]) and any(v[0] for v in got.values())


def test_chain_of_forms(spark):
    chain = ["abcdef" + "x" * k for k in range(7)]
    words = [w for k, w in enumerate(chain) for _ in range(3 * 2**k)]
    got = found(variants.spelling_variants(words_frame(spark, words)))
    assert {v[1] for v in got.values()} == {chain[-1]} and got[chain[0]] == (chain[1], chain[-1], 3, 1, 6)


def test_very_long_words(spark):
    long = "acgt" * 5000
    words = [long] * 6 + [long[:-1]] * 3 + ["x" + long[1:]] * 3 + ["y" + long[1:]] * 3
    got = found(variants.spelling_variants(words_frame(spark, words)))
    assert got[long][3] == 3 and got["x" + long[1:]] == (long, long, 3, 2, 6) and got[long[:-1]][0] == long


def test_occurrences_and_whole_query_equal_brute_force(spark, documents, texts):
    assert sorted(r["word"] for r in variants.words_of(documents).collect() if len(r["word"]) >= 5) == sorted(brute.occurrences(texts))
    some = texts[:60]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    assert found(variants.spelling_variants(variants.words_of(frame))) == brute.variants(brute.occurrences(some))


def test_odd_rows(spark, odd, none):
    assert variants.spelling_variants(variants.words_of(none)).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows += [(None, "Àlpha ÀLPHA àlpha alpha ×÷××× naïvE " * 2), (None, "Àlpha")] * 2
    frame = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, word string")
    assert sorted(r["word"] for r in variants.words_of(frame).collect() if len(r["word"]) >= 5) == sorted(brute.occurrences(rows))
    assert found(variants.spelling_variants(variants.words_of(frame))) == brute.variants(brute.occurrences(rows))
    assert variants.spelling_variants(spark.createDataFrame([(None,)] * 4, "word string")).count() == 0
