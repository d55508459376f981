"""Readings out of a pronunciation's text, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions import text as T


#: Everything that reading() may tell about a pronunciation.
REASONS = (
    "notes_extracted", "brackets_extracted", "unrecognized_brackets", "slash_alternatives", "letters_normalized", "width_letters_normalized", "em_spaces_normalized",
    "unresolved_question_mark", "unresolved_private_use", "unresolved_missing_primary", "unresolved_metadata",
)


def reading(primary: Column, original: Column, has_notes: Column) -> Column:
    """STRUCT<readings, retain_source, reasons, unresolved> of a pronunciation."""
    def of_whole(whole: Column) -> Column:
        bracketed = whole.startswith("［") | whole.startswith("[")
        return T.let(F.struct(bracketed.alias("bracketed"), (bracketed & T.bracket_tiles(whole)).alias("tiled")), lambda b: of_value(b, inside(whole, b)))

    def inside(whole: Column, b: Column) -> Column:
        return F.when(b["tiled"], T.strip(T.before_bopomofo(T.first_bracket(whole)))).when(b["bracketed"], "").otherwise(whole)

    def of_value(b: Column, value: Column) -> Column:
        # The whole is normalized once: a slash neither composes with its neighbours nor is white space.
        plain = lambda v: F.translate(T.drop_nul(v), T.LOOKALIKES, T.PLAIN)
        texts = lambda v: T.let(plain(v), lambda p: F.arrays_zip(T.split_alternatives(v).alias("raw"), F.split(T.nfc(p), "/", -1).alias("name"), F.split(T.nfd(p), "/", -1).alias("flat")))
        parts = F.transform(T.let(value, texts), lambda x: T.let(F.struct(x["raw"].alias("raw"), T.strip(x["name"]).alias("name"), T.strip(x["flat"]).alias("flat")), judged))
        return T.let(parts, lambda found: told(b, found))

    def judged(x: Column) -> Column:
        ok = (x["name"] != "") & x["flat"].rlike("[A-Za-z]") & x["flat"].rlike(f"^[{T.READING_CLASS}]*$")
        return F.struct(x["raw"].alias("raw"), x["name"].alias("name"), ok.alias("ok"))

    def why(n: Column) -> Column:
        kind = F.when(n.contains("?"), "unresolved_question_mark").when(T.has_private_use(n), "unresolved_private_use")
        return kind.when(n == "", "unresolved_missing_primary").otherwise("unresolved_metadata")

    shown = F.length(T.strip(original)) > 0

    def of_part(x: Column) -> Column:
        raw = x["raw"]
        marks = [F.when(raw.rlike("[ɡɑｅｋ]"), "letters_normalized"), F.when(raw.rlike("[ｅｋ]"), "width_letters_normalized"), F.when(raw.contains("\u2003"), "em_spaces_normalized"), F.when(~x["ok"] & shown, why(x["name"]))]
        return F.array_compact(F.array(*marks))

    def told(b: Column, found: Column) -> Column:
        good = F.array_distinct(F.transform(F.filter(found, lambda x: x["ok"]), lambda x: x["name"]))
        before = [F.when(has_notes, "notes_extracted"), F.when(b["tiled"], "brackets_extracted").when(b["bracketed"], "unrecognized_brackets"), F.when(F.size(found) > 1, "slash_alternatives")]
        reasons = F.array_distinct(F.concat(F.array_compact(F.array(*before)), F.flatten(F.transform(found, of_part))))
        open_ = F.filter(found, lambda x: ~x["ok"] & shown)
        odd = F.sort_array(F.array_distinct(F.flatten(F.transform(open_, lambda x: T.odd_codepoints(x["name"])))))
        return F.struct(
            T.let(good, lambda g: F.when(F.size(g) > 0, g).otherwise(F.array(F.lit("")))).alias("readings"),
            (b["bracketed"] | (F.size(open_) > 0)).alias("retain_source"),
            reasons.alias("reasons"),
            odd.alias("unresolved"),
        )

    return T.let(T.strip(primary), of_whole)
