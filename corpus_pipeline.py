"""The corpus pipeline: language identification, near-duplicate removal, benchmark decontamination, secret redaction,
packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns the columns of documents;
the last returns the packed pieces.  A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, fold, table
from glyphmill.llm.decontaminate import leaks
from glyphmill.llm.langid import identify
from glyphmill.llm.minhash import near_duplicates
from glyphmill.llm.packing import pack, tokenizer_path
from glyphmill.llm.secrets import secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language has less than this share of the posterior isn't in any learned language; neither is one of
#: LONG bytes or more whose best model needs more bits a byte than knowing nothing takes.
LEAST_SCORE, MOST_BITS, LONG = 0.5, 8.0, 64
SEQUENCE = 2048


def row_key() -> Column:
    """A row's own key: its id, in an order that text keeps (null ids last), and a hash of its text."""
    place = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    return F.concat(F.coalesce(place, F.lit("~")), F.lit("-"), F.coalesce(F.hex(F.xxhash64("text")), F.lit("")))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects null texts, texts without a letter and texts that no language explains; lang becomes the prediction.

    Rows with a null id are judged and learned from like others; repeated rows stay; an empty table gives none.
    """
    rows = docs.select(*COLUMNS)
    found = identify(rows, rows.where(fold(F.col("doc_id"), 4) != 2))
    explained = (F.col("bits_per_byte") <= MOST_BITS) | (F.octet_length("text") < LONG)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE) & explained)
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id.

    Rows are told apart by id and text, so texts under one id, or under none, are documents of their own, and a row that
    is there twice stays once.  A text without words, null ones too, is like no other and stays.
    """
    rows = docs.select(*COLUMNS).withColumn("_row", row_key())
    found = near_duplicates(rows.select("_row", "text"), key="_row").where("kept").select("_row").distinct()
    return rows.join(found, "_row").dropDuplicates(["_row"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, verbatim or paraphrased.

    Rows are told apart by id and text, so rows with a null id are judged each by its own text.  Null and empty texts
    hold nothing and stay; repeated rows go or stay alike.
    """
    rows = docs.select(*COLUMNS).withColumn("_row", row_key())
    hits = leaks(rows.select("_row", "text"), table(spark, sf_dir, "benchmark"), key="_row").select("_row").distinct()
    return rows.join(hits, "_row", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets, encoded ones too, by a mark; n_chars follows the text.  Every row stays, null texts as they are."""
    found = secrets(docs.select(*COLUMNS), redact=True)
    return found.select("doc_id", "text", "lang", "source", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("text").cast("long")).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of at most 2048 tokens.

    A null or empty text is a piece of one token; rows with a null id and repeated rows are packed each.
    """
    return pack(docs.select("doc_id", "text"), tokenizer_path(), SEQUENCE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]
#: Language models, signatures and tokenizers aren't SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
