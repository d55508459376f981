from glyphmill.functions import markup
from glyphmill.operators import classify, emit, validate
from glyphmill.streaming import stateless

HDC = "<hdc><hm><hw>{}</hw><pron>gā/gà</pron></hm><item>x</item></hdc>"
ROWS = [(1, "a", "@@@LINK=b"), (2, "b", HDC.format("b")), (3, "x1", "<ul></ul>"), (4, "b", HDC.format("b") * 2), (5, "c", "plain")]


def streamed(spark, frame, folder, name, make):
    frame.repartition(2).write.parquet(folder)
    query = make(spark.readStream.schema(frame.schema).parquet(folder)).writeStream.format("memory").queryName(name).start()
    query.processAllAvailable()
    query.stop()
    return spark.sql(f"SELECT * FROM {name}").collect()


def test_stream_of_records_equals_batch(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, "ordinal long, headword string, raw string")
    got = streamed(spark, frame, str(tmp_path / "a"), "terms", lambda s: stateless.first_seen(stateless.canonical_terms(s)))
    canonical = classify.classify(frame).where("kind = 'canonical'")
    terms = emit.canonical_terms(emit.entries(markup.parsed(canonical.select("id", "headword", "raw"))))
    want = {r["s"] for r in terms.select(emit.signature(terms["glossary"]).alias("s")).collect()}
    assert len(got) == len(want) == 5 and {r["signature"] for r in got} == want


def test_stream_of_rows_equals_batch(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0, "[]"), (1, 1, '["e","?","","",0,[],1,""]')], "bank long, place long, row string")
    got = streamed(spark, frame, str(tmp_path / "b"), "faults", stateless.faulty_rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, validate.row_errors(frame).collect())) and len(got) == 2
