import pytest

import corpus_pipeline as cp
from glyphmill.llm import secrets
from glyphmill.llm.common import cut
from tests.llm import brute
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def stages(spark, documents):
    out, docs = {"documents": documents}, documents
    for name, stage in cp.STAGES:
        out[name] = docs = cut(stage(spark, docs, SF), f"test-{name}")
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_return_documents(stages):
    for name in ("language", "near_duplicates", "decontamination", "secrets"):
        assert tuple(stages[name].columns) == cp.COLUMNS


def test_language_keeps_clean_documents(stages):
    assert len(ids(stages["documents"])) - len(ids(stages["language"])) <= 2


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["language"].collect()]
    assert ids(stages["near_duplicates"]) == {c for _, c in brute.near(rows).values()}


def test_no_item_is_left(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = ({r["doc_id"]: r["text"] for r in stages[s].collect()} for s in ("near_duplicates", "decontamination"))
    held = {d for d, t in before.items() if any(i in t for i in items)}
    assert not held & set(after) and len(before) - len(after) - len(held) <= 1


def test_no_secret_is_left_and_no_document_lost(stages):
    before, after = ({r["doc_id"]: r for r in stages[s].collect()} for s in ("decontamination", "secrets"))
    assert set(before) == set(after)
    for d, r in after.items():
        assert not secrets.find(r["text"])[1]
        spans = secrets.find(before[d]["text"])[1]
        assert r["text"] == (secrets.redacted(before[d]["text"], spans) if spans else before[d]["text"])


def test_all_is_packed(spark, stages):
    assert ids(stages["packing"]) == ids(stages["secrets"])
    assert cp.run(spark, SF).count() == stages["packing"].count()


def test_stages_take_odd_tables(spark, odd, none):
    for name, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0, name
        stage(spark, odd, SF).count()


def test_rows_without_an_id_and_repeated_ids(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    say = lambda k: " ".join(f"{w}{k}" for w in "one two three four five six seven eight nine ten".split())
    rows = [(None, f"{say('a')} {item}"), (None, say("b")), (None, say("b")), (None, say("c")), (7, say("c")), (7, say("d")), (3, say("d")), (7, say("e")), (7, say("e")), (-2, say("f")), (10, say("f")), (None, None)]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    listed = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    one = cp.keep_one_of_near_duplicates(spark, frame, SF)
    assert listed(one) == sorted([rows[0], rows[1], (7, say("c")), (3, say("d")), (7, say("e")), (-2, say("f")), (None, None)], key=str)
    assert listed(cp.drop_contaminated(spark, frame, SF)) == sorted(rows[1:], key=str)


def test_texts_of_no_learned_language_go(spark, stages):
    rows = stages["documents"].select(*cp.COLUMNS).limit(150)
    more = spark.createDataFrame([(9001, "Это совсем другой язык, который здесь никто не учил. " * 3), (9002, "日本語の文章はここでは学ばれていない。" * 5), (9003, "The")], "doc_id long, text string").selectExpr("doc_id", "text", "cast(null as string) lang", "'s' source", "cast(length(text) as long) n_chars")
    kept = ids(cp.keep_known_languages(spark, rows.union(more), SF))
    assert not kept & {9001, 9002} and 9003 in kept and len(kept) >= 148


def test_language_stage_matches_a_plain_model(spark, stages):
    rows = stages["documents"].collect()
    learn = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        if r["lang"] and r["text"] and brute.fold(r["doc_id"], 4) != 2:
            learn.setdefault(r["lang"], []).append(r["text"])
    kept = {r["doc_id"]: r["lang"] for r in stages["language"].collect()}
    grams = {l: {g for t in ts for g in zip(t, t[1:], t[2:], strict=False)} for l, ts in learn.items()}
    for r in rows:  # the language whose texts hold most of the text's runs of three characters
        if r["text"] and len(r["text"]) > 200 and r["doc_id"] in kept:
            own = list(zip(r["text"], r["text"][1:], r["text"][2:], strict=False))
            share = sorted(((sum(g in x for g in own), l) for l, x in grams.items()), reverse=True)
            assert kept[r["doc_id"]] == share[0][1] or share[0][0] - share[1][0] < 0.1 * len(own)
    letters = {r["doc_id"] for r in rows if r["text"] and any(c.isalpha() for c in r["text"])}
    assert set(kept) <= letters and len(letters - set(kept)) <= 2


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
