"""Text as Column expressions.  All run in the JVM: normalization and case folding are those of ICU, which Spark brings
along for its collations; ASCII strings are passed by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"
# Look-alike letters and the blank that readings are written with, and what they stand for.
LOOKALIKES, PLAIN = "ɡɑｅｋ\u2003", "gaek "
# The characters of a clean reading after decomposition.
#: Phonetic symbols, as ranges of a character class.
BOPOMOFO = "\u3100-\u312f\u31a0-\u31bf"
READING_CLASS = "A-Za-z ,，､、'’\\-\u0300\u0301\u0302\u0304\u0308\u030c"
# Elements that make a text look executable, beside event handlers.
EXECUTABLE = ("script", "iframe", "object", "embed", "form", "audio", "video")


def _icu(name: str, method: str, c: Column, flag: bool) -> Column:
    """A static ICU method of a string and a flag; ASCII strings stay as they are."""
    odd = c.rlike(NON_ASCII)
    return F.when(odd, F.call_function("java_method", F.lit(f"com.ibm.icu.{name}"), F.lit(method), F.coalesce(c, F.lit("")), F.lit(flag))).otherwise(c)


def nfc(c: Column) -> Column:
    """Canonical composition."""
    return _icu("text.Normalizer", "compose", c, False)


def nfd(c: Column) -> Column:
    """Canonical decomposition."""
    return _icu("text.Normalizer", "decompose", c, False)


def casefold(c: Column) -> Column:
    """Full case folding: like lower(), and sharp s becomes ss."""
    return _icu("lang.UCharacter", "foldCase", F.lower(c), True)


def let(c: Column, then: Callable[[Column], Column]) -> Column:
    """then(c), with c computed once however often it is named: within functions of arrays Spark computes each mention."""
    return F.transform(F.array(c), then)[0]


#: Unicode white space; U+001C-001F count as such.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at both ends; what lies between isn't looked at."""
    return F.trim(c, F.lit(SPACES))


def drop_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\x00"), F.lit(""))


def normalize_text(c: Column) -> Column:
    """NUL dropped, composed, stripped."""
    return strip(nfc(drop_nul(c)))


def normalize_reading(c: Column) -> Column:
    """Like normalize_text, with look-alike letters replaced before composition."""
    return strip(nfc(F.translate(drop_nul(c), LOOKALIKES, PLAIN)))


def is_clean_reading(c: Column) -> Column:
    """Empty, or normalized already and made of reading characters with at least one letter."""
    flat = nfd(c)
    return (c == "") | ((c == normalize_reading(c)) & flat.rlike("[A-Za-z]") & flat.rlike(f"^[{READING_CLASS}]*$"))


def has_private_use(c: Column) -> Column:
    return c.rlike(r"\p{Co}")


def is_usable(c: Column) -> Column:
    """Some letter, number, symbol or other-category character that isn't white space."""
    return c.rlike(r"(?U)[\p{L}\p{N}\p{S}\p{C}&&[^\s]]")


def split_alternatives(c: Column) -> Column:
    """Parts between slashes, empty ones too."""
    return F.split(c, "/", -1)


def before_bopomofo(c: Column) -> Column:
    return F.element_at(F.split(c, f"[{BOPOMOFO}]", 2), 1)


def bracket_tiles(c: Column) -> Column:
    """The text consists of bracket groups, without nesting, and white space."""
    return c.rlike("^(?U:\\s*(?:［[^［］]*］|\\[[^\\[\\]]*\\]))+\\s*$")


def first_bracket(c: Column) -> Column:
    """Content of the first bracket group."""
    return F.regexp_extract(c, "(?U)^\\s*[［\\[]([^［］\\[\\]]*)[］\\]]", 1)


def count_literal(c: Column, what: Column) -> Column:
    """Occurrences of a literal that don't overlap; 0 for the empty one."""
    n = (F.length(c) - F.length(F.replace(c, what, F.lit("")))) / F.length(what)
    return F.when(F.length(what) > 0, n).otherwise(0).cast("long")


def replace_first(c: Column, before: Column, after: Column) -> Column:
    """The first occurrence of a literal replaced; unchanged without one."""
    at = F.position(before, c)
    replaced = F.concat(F.substring(c, F.lit(1), at - 1), after, F.substring(c, at + F.length(before), F.length(c)))
    return F.when(at > 0, replaced).otherwise(c)


def url_quote(c: Column) -> Column:
    """Percent encoding of all but unreserved characters and the slash."""
    out = F.url_encode(c)
    for was, now in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(was), F.lit(now))
    return out


def url_unquote(c: Column) -> Column:
    """Percent decoding; a plus stays a plus, and a percent sign without two digits one, too."""
    whole = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(whole), c)).otherwise(c)


def resource_path(c: Column) -> Column:
    """The name under which a resource is looked up: decoded, slashes one way, without scheme and host, without dot
    segments and leading slashes, case folded."""
    flat = F.replace(url_unquote(c), F.lit("\\"), F.lit("/"))
    path = F.when(flat.contains("://"), F.regexp_extract(flat, "^[^:/?#]*://[^/?#]*([^?#]*)", 1)).otherwise(flat)
    parts = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "."))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, x)),
    )
    return casefold(F.array_join(kept, "/"))


def suffix(c: Column) -> Column:
    """Extension with its dot, of the last path part; empty if there's none."""
    return F.lower(F.regexp_extract(c, r"[^./](\.[^./]+)$", 1))


def content_name(content: Column, ext: Column) -> Column:
    """Name of a media file by its content; .jpeg becomes .jpg."""
    ext = F.when(F.lower(ext) == ".jpeg", ".jpg").otherwise(F.lower(ext))
    return F.concat(F.lit("media/"), F.substring(F.sha2(content, 256), 1, 24), ext)


def canonical_json(c: Column) -> Column:
    """JSON text with sorted keys, compact; null for what isn't JSON."""
    return F.to_json(F.try_parse_json(c))


def codepoint_label(c: Column) -> Column:
    """U+ and at least four hexadecimal digits, of a one-character string."""
    digits = F.hex(F.ascii(c))
    return F.concat(F.lit("U+"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def odd_codepoints(c: Column) -> Column:
    """Sorted labels of the private-use, control and format characters."""
    chars = F.array_distinct(F.regexp_extract_all(c, F.lit(r"([\p{Co}\p{Cc}\p{Cf}])"), F.lit(1)))
    return F.sort_array(F.transform(chars, codepoint_label))


def strip_corner_brackets(c: Column) -> Column:
    return F.when(c.startswith("「") & c.endswith("」") & (F.length(c) >= 2), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def without_note_comma(c: Column) -> Column:
    """Without the comma that a note was separated by."""
    return F.regexp_replace(c, "(?U)[,，]\\s*$", "")


def looks_executable(c: Column) -> Column:
    """Something like an active element or an event handler."""
    return c.rlike(rf"(?iU)<(?:{'|'.join(EXECUTABLE)})\b|\bon\w+\s*=")


def is_unsafe_path(c: Column) -> Column:
    return c.startswith("/") | c.contains("\\") | c.rlike(r"(^|/)\.\.(/|$)")


def span_number(c: Column) -> Column:
    """A table span as a number; null where it isn't made of digits."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def revision(base: str, version: str, source_sha256: str, override: str | None = None) -> str:
    return override or f"{base}+converter-{version}+{source_sha256[:12]}"
