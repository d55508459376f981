"""Spelling variants by wildcard groups, without pairs.

1. Vocabulary.  Runs of letters are counted over all texts, partly summed before the shuffle, and the words that are
   long and frequent enough are numbered in code-point order: ids grow with the words, so a tie is told by ids and the
   shuffles that follow carry numbers only.
2. Replacements.  A word belongs to a wildcard group (position, prefix, suffix) for each of its letters.  Two words of
   one group differ in this one letter, and in no other group do they meet again.  So a group's size and its top two
   words say it all: each member has size - 1 near words there, the best of which is the top word, or the second for the
   top word itself.  A group has one member a letter of the alphabet at most, ALPHABET in all, however large the
   vocabulary is.
3. Insertions and deletions.  A word without one of its letters is joined with the vocabulary; each such row meets one
   word at most, and tells the longer word of the shorter one and the other way round.  That is one row a letter.
4. Near words are counts and bests added up by word; the two kinds can't overlap, since the lengths differ.  Forms are at
   least `factor` times as frequent, so they make trees, and roots go down them a level at a time: a word is the form of
   few others (its own letters times the alphabet), so no key is hot.

Words beyond LONG letters aren't spelled out once a letter, which would take the square of their length: their keys are
residues of a polynomial modulo a 127-bit prime, all of them told in one pass over the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, discard, table

#: Runs of letters; `A-Z` alone is lower-cased, so words are over ALPHABET letters.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = 26 + 64
MIN_LENGTH, MIN_COUNT, FACTOR = 5, 3, 2
#: Letters up to which a word stands for itself in a key.
LONG = 40
_PRIME, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F


def lowered(run: Column) -> Column:
    """run with A-Z in lower case, other letters as they are."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def misspelled(doc_id: Column, word: Column, one_in: int) -> Column:
    """The word without one letter where the crc32 of `<doc_id>:<word>` is a multiple of one_in, the letter at that crc32
    modulo the length; else the word.  A null id counts as no text."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(h, F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % one_in == 0, shorter).otherwise(word)


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(id, word, n) of the words (a column `word`, a row an occurrence) that are long and frequent enough; ids are in
    code-point order, not without gaps."""
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    in_order = cut(counted, "counted").repartitionByRange("word").sortWithinPartitions("word")
    return cut(in_order.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def _residues(word: str) -> tuple[list[int], list[int], list[int]]:
    """Of each prefix, of each suffix, and the powers of the base."""
    prefix, power = [0], [1]
    for c in word:
        prefix.append((prefix[-1] * _BASE + ord(c)) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    suffix, n = [0], len(word)
    for k in range(n):
        suffix.append((ord(word[n - 1 - k]) * power[k] + suffix[-1]) % _PRIME)
    return prefix, suffix, power


def _key(length: int, residue: int) -> str:
    return f"#{length}:{residue:x}"


def own_key(word: str) -> str:
    """What a word is known by: itself, or its length and residue."""
    return word if len(word) <= LONG else _key(len(word), _residues(word)[0][-1])


def wildcard_keys(word: str) -> Iterator[str]:
    """A key for each position; equal for words that differ there only."""
    n = len(word)
    if n <= LONG:
        yield from (f"{word[:i]}*{word[i + 1:]}" for i in range(n))
        return
    prefix, suffix, power = _residues(word)
    for i in range(n):
        yield f"{i}{_key(n, (prefix[i] * power[n - i] + suffix[n - 1 - i]) % _PRIME)}"


def deletion_keys(word: str) -> set[str]:
    """own_key() of the word without one of its letters."""
    n = len(word)
    if n <= LONG + 1:
        return {word[:i] + word[i + 1 :] for i in range(n)}
    prefix, suffix, power = _residues(word)
    return {_key(n - 1, (prefix[i] * power[n - 1 - i] + suffix[n - 1 - i]) % _PRIME) for i in range(n)}


def _by_python(rows: DataFrame, keys) -> DataFrame:
    """(key, id, n): a row for each of keys(word)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, n, word in zip(b["id"], b["n"], b["word"], strict=True):
                found = list(keys(word))
                for at in range(0, len(found), 100_000):
                    yield pd.DataFrame({"key": found[at : at + 100_000], "id": i, "n": n})

    return rows.select("id", "n", "word").mapInPandas(run, "key string, id long, n long")


def _keys(words: DataFrame, up_to: int, native: str, by_python) -> DataFrame:
    """(key, id, n) of words; those of up_to letters or fewer by the SQL expression `native`, an array."""
    size = F.length("word")
    short = words.where(size <= up_to).select(F.explode(F.expr(native)).alias("key"), "id", "n")
    return short.union(_by_python(words.where(size > up_to), by_python))


_WITHOUT = "transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), {}substring(word, i + 1)))"


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best: n and id of the near word of largest n, ties to the smaller id) of words that have near ones."""
    rank = F.struct((-F.col("n")).alias("minus_n"), "id")
    wild = _keys(words, LONG, _WITHOUT.format("'*', "), wildcard_keys)
    groups = wild.groupBy("key").agg(F.sort_array(F.collect_list(rank)).alias("members")).where(F.size("members") > 1)
    groups = groups.select((F.size("members") - 1).alias("near"), F.col("members")[0].alias("top"), F.col("members")[1].alias("second"), F.explode("members").alias("own"))
    replaced = groups.select(F.col("own.id").alias("id"), "near", F.when(F.col("own.id") == F.col("top.id"), F.col("second")).otherwise(F.col("top")).alias("best"))

    shorter = _keys(words, LONG + 1, f"array_distinct({_WITHOUT.format('')})", deletion_keys)
    shorter = shorter.select("key", F.struct((-F.col("n")).alias("minus_n"), "id").alias("long"))
    known = _keys(words, LONG, "array(word)", lambda word: [own_key(word)]).select("key", rank.alias("short"))
    met = shorter.join(known, "key")
    told = met.select(F.explode(F.array(F.struct(F.col("long.id").alias("id"), F.col("short").alias("best")), F.struct(F.col("short.id").alias("id"), F.col("long").alias("best")))).alias("x"))
    indel = told.select("x.id", F.lit(1).alias("near"), "x.best")
    return replaced.union(indel).groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(edges: DataFrame) -> DataFrame:
    """(id, root) for each id of edges (id, form), a forest: where the forms end."""
    left = edges
    tops = edges.select(F.col("form").alias("id")).distinct().join(edges.select("id"), "id", "left_anti")
    level = tops.select(F.col("id").alias("form"), F.col("id").alias("root"))
    found = None
    while True:
        level = cut(left.join(level, "form").select("id", "root"), "level")
        if level.isEmpty():
            return level if found is None else found
        found = level if found is None else found.union(level)
        level = level.withColumnRenamed("id", "form")


def spelling_variants(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each distinct value of the column `word` that has min_length letters and
    min_count occurrences, a row of words each.

    Two words are near if one letter inserted, deleted or replaced makes one the other.  form is the near word of largest
    n (ties: smallest in code-point order) if that is factor times n or more, else null; root is where the forms end, the
    word itself without one.  Null words count for nothing; an empty table gives none.  factor has to be above 1.
    """
    vocab = vocabulary(words.select("word"), min_length, min_count)
    near = cut(near_words(vocab), "near")
    linked = vocab.join(near, "id", "left")
    form_n = -F.col("best.minus_n")
    linked = linked.withColumn("form_id", F.when(form_n >= factor * F.col("n"), F.col("best.id")))
    edges = cut(linked.where(F.col("form_id").isNotNull()).select("id", F.col("form_id").alias("form")), "edges")
    names = vocab.select(F.col("id").alias("name_id"), F.col("word").alias("name"))
    named = edges.join(roots(edges), "id")
    named = named.join(names.select(F.col("name_id").alias("form"), F.col("name").alias("form_word")), "form")
    named = named.join(names.select(F.col("name_id").alias("root"), F.col("name").alias("root_word")), "root").select("id", "form_word", "root_word")
    out = cut(linked.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form_n.alias("best_n")).join(named, "id", "left"), "variants")
    discard(near)
    return out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", F.when(F.col("form_word").isNotNull(), F.col("best_n")).alias("form_n")
    )


def words_of(docs: DataFrame, key: str = "doc_id", text: str = "text", one_in: int = 97) -> DataFrame:
    """A row (word) for each run of letters of docs, as lowered() and misspelled() make it.  Null texts have none; rows
    count as often as they are repeated; other columns play no part."""
    runs = docs.select(F.col(key).alias("doc"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.where(F.length("run") >= MIN_LENGTH).select("doc", lowered(F.col("run")).alias("word"))
    return words.select(misspelled(F.col("doc"), F.col("word"), one_in).alias("word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, a letter of each 97th left out, with their near words, forms and roots."""
    return spelling_variants(words_of(table(spark, sf_dir, "documents").select("doc_id", "text")))


#: The checksum's table and steps are spelled out, since the dialect has no crc32; near pairs come from two plain joins.
_SQL = f"""
WITH RECURSIVE steps AS (
    SELECT i AS byte, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
    UNION ALL
    SELECT byte, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
),
crc AS (SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), '{UPPER}', '{LOWER}') AS run FROM documents
),
distinct_runs AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
summed AS (
    SELECT run, times, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(doc_id::VARCHAR || ':' || run))),
            lambda i: ('0x' || substr(hex(encode(doc_id::VARCHAR || ':' || run)), (2 * i + 1)::INT, 2))::BIGINT)),
        lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]))) AS h
    FROM distinct_runs, crc
),
made AS (
    SELECT times, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM summed
),
words AS (SELECT word, sum(times)::BIGINT AS n FROM made WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
cuts AS (
    SELECT word, n, i, left(word, i::INT) || '*' || substr(word, i::INT + 2) AS wild, left(word, i::INT) || substr(word, i::INT + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.wild = b.wild AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word
),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {FACTOR} * w.n THEN other END AS form,
        CASE WHEN other_n >= {FACTOR} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)
),
down AS (
    SELECT word, word AS root FROM formed WHERE form IS NULL
    UNION ALL
    SELECT f.word, d.root FROM formed f JOIN down d ON f.form = d.word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN down USING (word)
"""

QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLE: dict[str, str] = {"op11_spelling_variants": _SQL}
