import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


#: Documents with everything that may go wrong: nulls, empty and very long texts, ties, repeated rows, odd spaces.
ODD = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"),
    (2, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "Short"),
    (7, "short"),
    (8, "long " * 30_000),
    (9, "é\u00a0x\u2003y \x1c z"),
    (10, "abc " * 40 + "end"),
    (11, "xyz " + "abc " * 40),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with extra columns named like what operators make inside."""
    rows = [(d, t, "en", "s", 0, "x", 1) for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, pos int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
