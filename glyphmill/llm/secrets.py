"""Secret scans by a recursive decoding worklist.

The text itself is the first layer.  Each layer is scanned for the three kinds of secrets, and everything in it that
looks encoded is unwrapped into further layers:

* percent escapes and other ones (``\\uXXXX``, ``\\u{X}``, ``\\UXXXXXXXX``, ``%uXXXX``, ``\\xXX``, ``\\101``, ``&#NN;``, with its
  semicolon or without, ``\\n`` and the like, ``&quot;`` and the like) rewrite the whole layer; beside percent escapes a
  layer of its own has blanks for pluses,
* each base64 run of 16 or more characters, and each hex run of 24 or more digits (the shortest secret has 12 bytes), is
  decoded at every alignment, so what stands before a blob in the same run does not hide it; each stretch of readable
  ASCII in it, in one, two or four bytes a character, the content of each gzip, zlib or bzip2 stream that begins in it, and
  that of a deflated stream without a header that begins where the run does, is a layer of its own.  Secrets and all that can be unwrapped are ASCII, so nothing is lost between the stretches,
* runs on consecutive lines, quoted or continued ones too, are decoded joined as well.

The worklist ends at a fixpoint.  What a layer holds is worked out once for each content (by digest) and mapped to every
place where this content occurs, so of two copies of one blob both are found; a content that occurs within itself is a
cycle and is not entered again.  Decoding always shrinks a layer except for compressed streams; their content is taken in
windows of WINDOW bytes that overlap by OVERLAP, so a stream of any size is scanned whole in bounded memory.  Only what is
itself longer than OVERLAP may be cut there; such rows are counted in n_oversize.

Every layer knows how its characters map to its parent's, so a find is reported as the span of the original text that
it came from: exact for escapes, whole quadruples for base64, whole pairs for hex, for streams all of the run from where
they begin.

All of a document is done in one pass over its row: a plain map, no shuffle.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import parts, table

# Fixed values of the contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN = 6

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: A form's encoding: a plus is a blank there.
FORM = re.compile(r"(?:%[0-9A-Fa-f]{2}|\+)+")
# Escapes that name their character, in programs and in markup.
LETTERS = {"n": "\n", "r": "\r", "t": "\t", '"': '"', "'": "'", "/": "/", "\\": "\\"}
NAMED = {"quot": '"', "apos": "'", "amp": "&", "lt": "<", "gt": ">", "equals": "=", "colon": ":", "nbsp": "\xa0"}
ESCAPE_ONE = re.compile(
    r"(?:\\[uU]|%u|\\x)(?:\{(?P<braced>[0-9A-Fa-f]{1,8})\}|(?<=\\U)(?P<eight>[0-9A-Fa-f]{8})|(?<=[\\%]u)(?P<four>[0-9A-Fa-f]{4})|(?<=x)(?P<two>[0-9A-Fa-f]{2}))"
    r"|\\(?P<octal>[0-3][0-7]{2})|&#(?P<decimal>[0-9]{1,7});?|&#[xX](?P<hexadecimal>[0-9A-Fa-f]{1,6});?|\\(?P<letter>[nrt\"'/\\])|&(?P<named>" + "|".join(NAMED) + ");"
)
ESCAPE = re.compile(f"(?:{re.sub(r'[?]P<[a-z]+>', '?:', ESCAPE_ONE.pattern)})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{24,}")
#: Runs on consecutive lines, the first and last of which may hold other text, too; lines may be quoted or continued.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\\?\r?\n[ \t>|#*]*+[A-Za-z0-9+/_-]++)++={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
#: The same in UTF-16 and UTF-32, of either byte order: from the first byte that isn't zero on.
READABLE_16 = re.compile(rb"(?:[\t\n\r\x20-\x7e]\0){11,}[\t\n\r\x20-\x7e]")
READABLE_32 = re.compile(rb"(?:[\t\n\r\x20-\x7e]\0\0\0){11,}[\t\n\r\x20-\x7e]")
#: Where a gzip, bzip2 or zlib stream may begin in base64 and in hex.
STREAM_64 = re.compile(r"(?=H4sI|Qlpo|e[A-P])")
STREAM_16 = re.compile(r"(?=1f8b|425a68|78)", re.I)
#: Bytes of a stream's content that make a layer, and bytes that a layer shares with the one before.
WINDOW, OVERLAP = 8 << 20, 1 << 20
#: Bytes of a stream that are inflated at once, and bytes that tell a chance beginning from a stream.
CHUNK, TRIAL = 1 << 16, 4096

Span = tuple[int, int, int]


def scan(text: str) -> list[Span]:
    """(start, kind, end) of the secrets in one layer: leftmost, not overlapping within a kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class _Rewrite:
    """Maps spans of a rewritten layer to its parent.  Both lists hold, for each rewritten stretch, where it starts
    and ends: in the child and in the parent."""

    def __init__(self) -> None:
        self.at: list[int] = [0]
        self.shift: list[int] = [0]
        self.parts: list[tuple[int, int, int, int]] = []

    def add(self, c0: int, c1: int, p0: int, p1: int) -> None:
        self.parts.append((c0, c1, p0, p1))
        self.at.append(c1)
        self.shift.append(p1 - c1)

    def _inside(self, pos: int) -> tuple[int, int, int, int] | None:
        k = bisect_right(self.parts, (pos, 1 << 62, 0, 0)) - 1
        return self.parts[k] if k >= 0 and self.parts[k][0] <= pos < self.parts[k][1] else None

    def __call__(self, start: int, end: int) -> tuple[int, int]:
        first, last = self._inside(start), self._inside(end - 1)
        p0 = first[2] if first else start + self.shift[bisect_right(self.at, start) - 1]
        p1 = last[3] if last else end + self.shift[bisect_right(self.at, end - 1) - 1]
        return p0, p1


def _rewrite(text: str, runs: re.Pattern, decode: Callable[[str], list[tuple[str, int]] | None]) -> tuple[str, _Rewrite] | None:
    """text with each run decoded; decode gives (character, length of its source) for a run."""
    out, to, done, size = [], _Rewrite(), 0, 0
    for m in runs.finditer(text):
        chars = decode(m[0])
        if chars is None:
            continue
        out.append(text[done : m.start()])
        size += m.start() - done
        p = m.start()
        for ch, n in chars:
            to.add(size, size + len(ch), p, p + n)
            out.append(ch)
            size, p = size + len(ch), p + n
        done = m.end()
    if not to.parts:
        return None
    out.append(text[done:])
    return "".join(out), to


def _percent(run: str) -> list[tuple[str, int]] | None:
    raw, out, i = bytes.fromhex(run.replace("%", "")), [], 0
    while i < len(raw):
        n = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        try:
            out.append((raw[i : i + n].decode(), 3 * n))
        except UnicodeDecodeError:
            n = 1
            out.append((chr(raw[i]), 3))
        i += n
    return out


def _form(run: str) -> list[tuple[str, int]] | None:
    """A run of percent escapes and pluses; a plus is a blank."""
    out: list[tuple[str, int]] = []
    for m in re.finditer(r"\+|[^+]+", run):
        out += [(" ", 1)] if m[0] == "+" else _percent(m[0])
    return out


def _escapes(run: str) -> list[tuple[str, int]] | None:
    out = []
    for m in ESCAPE_ONE.finditer(run):
        kind, value = m.lastgroup, m[m.lastgroup]
        if kind in ("letter", "named"):
            out.append(((LETTERS if kind == "letter" else NAMED)[value], len(m[0])))
            continue
        code = int(value, {"octal": 8, "decimal": 10}.get(kind, 16))
        if out and 0xDC00 <= code < 0xE000 and len(out[-1][0]) == 1 and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, n = out.pop()
            out.append((chr(0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00), n + len(m[0])))
        else:
            out.append((chr(code) if code < 0x110000 else "�", len(m[0])))
    return out


def _member(head: bytes):
    """A decompressor for what begins with head; None if that isn't a stream."""
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if head[:3] == b"BZh" else None


class _Feed:
    """Bytes that come in pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def peek(self, n: int) -> bytes:
        while len(self.held) < n and (more := next(self.pieces, None)) is not None:
            self.held += more
        return self.held[:n]

    def take(self) -> bytes:
        """What is held, or the next piece; empty at the end."""
        out, self.held = self.held or next(self.pieces, b""), b""
        return out


def _inflated(feed: _Feed) -> Iterator[bytes]:
    """Content of a compressed stream, all of its members, a piece at a time; it ends where the stream is damaged."""
    while (stream := _member(feed.peek(4))) is not None:
        try:
            while not stream.eof and (piece := feed.take()):
                while True:
                    yield (out := stream.decompress(piece, CHUNK))
                    piece = getattr(stream, "unconsumed_tail", b"")
                    if stream.eof or not piece and len(out) < CHUNK and getattr(stream, "needs_input", True):
                        break
        except (zlib.error, OSError, ValueError):
            return
        if not stream.eof:
            return
        feed.held = stream.unused_data + feed.held
        while feed.peek(1) == b"\0":  # padding between members
            feed.held = feed.held.lstrip(b"\0")


def _is_stream(head: bytes) -> bool:
    """Whether a stream begins here, as far as its first bytes tell."""
    stream = _member(head)
    try:
        return stream is not None and (stream.decompress(head, CHUNK) != b"" or not stream.eof)
    except (zlib.error, OSError, ValueError):
        return False


def _deflated(feed: _Feed) -> Iterator[bytes]:
    """Content of a deflated stream without any header, a piece at a time."""
    stream = zlib.decompressobj(-15)
    try:
        while not stream.eof and (piece := feed.take()):
            while piece and not stream.eof:
                yield stream.decompress(piece, CHUNK)
                piece = stream.unconsumed_tail
    except zlib.error:
        return


def _is_deflated(head: bytes, whole: bool) -> bool:
    """Whether a deflated stream without a header begins here: its content begins with something readable, and if head is
    the whole of it, it ends."""
    stream = zlib.decompressobj(-15)
    try:
        content = stream.decompress(head, CHUNK)
    except zlib.error:
        return False
    return (not whole or stream.eof or bool(stream.unconsumed_tail)) and any(p.search(content) for p in (READABLE, READABLE_16, READABLE_32))


def _windows(raw: bytes, bare: bool = False) -> Iterator[tuple[bytes, bool]]:
    """Content of the stream that raw begins with (bare: deflated, without a header), streams right inside of it unwrapped
    as well, in windows; and whether a window follows another."""
    feed, heads = _Feed(iter([raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)])), set()
    if bare:
        feed = _Feed(filter(None, _deflated(feed)))
    while (head := feed.peek(TRIAL)) not in heads and _is_stream(head):  # a stream that holds itself is a cycle
        heads.add(head)
        feed = _Feed(filter(None, _inflated(feed)))
    held, size, more = [], 0, False
    while piece := feed.take():
        held.append(piece)
        size += len(piece)
        if size >= WINDOW:
            window = b"".join(held)
            yield window, more
            held, more = [window[-OVERLAP:]], True
            size = len(held[0])
    if size and not (more and size <= OVERLAP):
        yield b"".join(held), more


def _unbase64(run: str) -> bytes:
    run = run[: len(run) - (len(run) % 4 == 1)]
    return base64.b64decode(run + "=" * (-len(run) % 4))


def _unhex(run: str) -> bytes:
    return bytes.fromhex(run[: len(run) & ~1])


Place = Callable[[int, int], tuple[int, int]]


def _runs(text: str) -> Iterator[tuple[str, Place, bool]]:
    """Layers from the encoded runs of one layer: text, map to this layer, whether it was cut off."""
    for m in BASE64.finditer(text):
        yield from _base64_run(m[0].rstrip("="), lambda a, b, m=m: (m.start() + a, m.start() + b), m.end())
    for m in HEX_RUN.finditer(text):
        yield from _unpacked(m[0], lambda a, b, m=m: (m.start() + a, m.start() + b), m.end(), _unhex, 1, 2, STREAM_16)
    for m in WRAPPED.finditer(text):
        starts, at, lines = [], [], []
        size = 0
        for line in LINE.finditer(text, m.start(), m.end()):
            starts.append(size)
            at.append(line.start())
            lines.append(line[0])
            size += len(line[0])
        if size < 16:
            continue
        joined = "".join(lines)

        def place(a: int, b: int, starts: list[int] = starts, at: list[int] = at) -> tuple[int, int]:
            i, j = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
            return at[i] + a - starts[i], at[j] + b - starts[j]

        yield from _base64_run(joined, place, m.end())
        for h in HEX_RUN.finditer(joined):
            yield from _unpacked(h[0], lambda a, b, h=h, place=place: place(h.start() + a, h.start() + b), place(h.start(), h.end())[1], _unhex, 1, 2, STREAM_16)


def _base64_run(run: str, place: Place, end: int) -> Iterator[tuple[str, Place, bool]]:
    return _unpacked(run.replace("-", "+").replace("_", "/"), place, end, _unbase64, 3, 4, STREAM_64)


def _readable(raw: bytes) -> Iterator[tuple[str, int, int]]:
    """Readable stretches: text, its first byte, bytes a character."""
    for m in READABLE.finditer(raw):
        yield m[0].decode("ascii"), m.start(), 1
    if b"\0" in raw:
        for m in READABLE_16.finditer(raw):
            yield m[0][::2].decode("ascii"), m.start(), 2
        for m in READABLE_32.finditer(raw):
            yield m[0][::4].decode("ascii"), m.start(), 4


def _unpacked(run: str, place: Place, end: int, decode: Callable[[str], bytes], per: int, width: int, begins: re.Pattern) -> Iterator[tuple[str, Place, bool]]:
    """Layers of one run, `per` bytes in `width` characters; end is where the run ends in its layer."""
    for shift in range(width):
        for text, first, each in _readable(decode(run[shift:])):

            def to(a: int, b: int, first: int = first, each: int = each, shift: int = shift) -> tuple[int, int]:
                c0, c1 = shift + (first + a * each) // per * width, shift - (-(first + b * each) // per) * width
                return (place(c0, c1)) if c1 < len(run) else (place(c0, len(run))[0], end)

            yield text, to, False
    # Streams; a short piece tells almost every chance beginning from one.  Without a header one is looked for where a run
    # begins.
    starts = [(m.start(), False) for m in begins.finditer(run) if _is_stream(decode(run[m.start() : m.start() + TRIAL]))]
    if (0, False) not in starts and _is_deflated(decode(run[:TRIAL]), len(run) <= TRIAL):
        starts.append((0, True))
    for at, bare in starts:
        start = place(at, len(run))[0]
        whole = lambda a, b, start=start: (start, end)
        for content, more in _windows(decode(run[at:]), bare):
            yield content.decode("utf-8", "replace"), whole, more
            for text, _, each in _readable(content):
                if each > 1:
                    yield text, whole, False


class _Layer:
    """A layer at work: what was found in it so far, and the layers in it that are still to be entered."""

    def __init__(self, text: str, digest: bytes, to: Place | None):
        self.text, self.digest, self.to = text, digest, to
        self.spans = set(scan(text))
        self.inner = self._layers()
        self.cyclic = False

    def _layers(self) -> Iterator[tuple[str, Place, bool]]:
        for runs, decode in ((PERCENT, _percent), (ESCAPE, _escapes)):
            if got := _rewrite(self.text, runs, decode):
                yield *got, False
                if runs is PERCENT and "+" in self.text:
                    yield *_rewrite(self.text, FORM, _form), False
        yield from _runs(self.text)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def find(text: str | None) -> tuple[list[Span], list[Span], int, int]:
    """Base spans, all spans, number of different layers, number of windows cut out of long streams.  Spans are
    (start, kind, end)."""
    text = text or ""
    known: dict[bytes, set[Span]] = {}
    top = _Layer(text, _digest(text), None)
    base = sorted(top.spans)
    path, entered, seen, over = [top], {top.digest}, {top.digest}, 0
    while True:
        layer = path[-1]
        inner = next(layer.inner, None)
        if inner is not None:
            content, to, more = inner
            over += more
            digest = _digest(content)
            if digest in entered:  # a cycle: what it holds is being worked out further up
                for x in path:
                    x.cyclic = True
            elif digest in known:
                layer.spans.update(_mapped(known[digest], to))
            else:
                seen.add(digest)
                entered.add(digest)
                path.append(_Layer(content, digest, to))
            continue
        path.pop()
        entered.discard(layer.digest)
        if not path:
            return base, sorted(layer.spans), len(seen), over
        if not layer.cyclic:
            known[layer.digest] = layer.spans
        path[-1].spans.update(_mapped(layer.spans, layer.to))


def _mapped(spans: set[Span], to: Place) -> Iterator[Span]:
    for a, kind, b in spans:
        start, end = to(a, b)
        yield start, kind, end


def listed(spans: list[Span]) -> str:
    """kind:start:end, by start, then kind, then end."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """text with each maximal run of covered characters replaced by `[SECRET]`."""
    out, done = [], 0
    for a, _, b in spans:
        if a >= done or not out:
            out += [text[done:a], "[SECRET]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def secrets(docs: DataFrame, text: str = "text", redact: bool = False) -> DataFrame:
    """docs with n_assign, n_access, n_hex (long, base spans), base_sha256, spans, n_layers, n_oversize added, and with
    redact=True the text column rewritten.

    Base spans are those of the text itself; the decoding worklist only adds to them.  Null and empty texts have no
    spans (and stay as they are).  Repeated rows are each scanned.  Columns of docs named like the added ones are
    replaced.
    """
    added = {"n_assign": F.lit(0).cast("long"), "n_access": F.lit(0).cast("long"), "n_hex": F.lit(0).cast("long"), "base_sha256": F.lit(""), "spans": F.lit(""), "n_layers": F.lit(0).cast("long"), "n_oversize": F.lit(0).cast("long")}
    names = list(added)
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, text):
            rows, texts = [], []
            for t in b[text]:
                t = t if isinstance(t, str) else None
                base, spans, layers, over = find(t)
                n = [sum(k == j for _, k, _ in base) for j in range(3)]
                rows.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), layers, over))
                texts.append(redacted(t, spans) if redact and t else t)
            b = b.assign(**{c: [r[i] for r in rows] for i, c in enumerate(names)})
            yield b.assign(**{text: texts}) if redact else b

    return docs.mapInPandas(run, docs.withColumns(added).schema)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of documents."""
    found = secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_oversize")


QUERIES = {"op3_secret_scan": op3_secret_scan}
ORACLE: dict[str, str] = {}
