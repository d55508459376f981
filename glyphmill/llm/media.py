"""Columns of ISO media containers, from their boxes alone.

A container is a tree of boxes.  The walk keeps a stack of (box, where it ends), so any nesting will do, and goes into
boxes that hold others only; payloads are never looked into.  What the sample tables of a track say is put together as
columns: which chunk a sample is in (sample-to-chunk runs), where that chunk begins (32 or 64 bit offsets), how large the
samples before it in the chunk are (one size for all, or a table of 32, 16, 8 or 4 bits each), when it is shown (runs of
durations) and whether it can be decoded by itself (the sync table; without one, every sample can).  Fragments tell the
same by runs of their own.  Samples are told as runs: consecutive ones of one kind whose bytes adjoin are one byte range,
so a track of 10**9 samples of one size takes as many ranges as it has gaps, and memory is bounded by the tables' bytes.

`stored` writes payloads as such containers: 8-bit samples, UNIT of them an access unit, CHUNK units a chunk, of which the
first is a sync unit.  A file depends on its payload only.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.common import cut, parts, table

UNIT, CHUNK, RATE = 64, 64, 8000

# Fixed values of the format: boxes that hold boxes.
HOLDERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"mvex", b"moof", b"traf"}
# Fixed values of the format: flags of fragment headers and runs, and of a sample.
BASE, DESCRIBED, LASTING, SIZED, FLAGGED, FROM_MOOF = 0x1, 0x2, 0x8, 0x10, 0x20, 0x20000
FROM, FIRST_FLAGS, DURATIONS, SIZES, FLAGS, SHIFTS = 0x1, 0x4, 0x100, 0x200, 0x400, 0x800
NOT_SYNC = 0x10000


class Fault(Exception):
    """What is wrong with a container, in a word."""


# --- writing


def box(kind: bytes, *inner: bytes) -> bytes:
    size = 8 + sum(map(len, inner))
    head = struct.pack(">I4s", size, kind) if size < 1 << 32 else struct.pack(">I4sQ", 1, kind, size + 8)
    return head + b"".join(inner)


def full(kind: bytes, *inner: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *inner)


def counted(kind: bytes, values: np.ndarray | list, width: int = 1, wide: bool = False) -> bytes:
    """A table: the number of its rows, then big-endian integers."""
    data = np.asarray(values, ">u8" if wide else ">u4")
    return full(kind, struct.pack(">I", len(data) // width), data.tobytes())


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _times(kind: bytes, before: bytes, duration: int, after: bytes, flags: int = 0) -> bytes:
    """A header box: created and changed at 0, then what stands between, then a duration of 32 or 64 bits."""
    if duration < 1 << 32:
        return full(kind, bytes(8), before, struct.pack(">I", duration), after, flags=flags)
    return full(kind, bytes(16), before, struct.pack(">Q", duration), after, version=1, flags=flags)


def container(payload: bytes) -> bytes:
    """The payload, whose length is a positive multiple of UNIT, as 8-bit samples of one track."""
    n = len(payload) // UNIT
    n_chunks = -(-n // CHUNK)
    last = n - CHUNK * (n_chunks - 1)
    runs = [1, min(n, CHUNK), 1] + ([n_chunks, last, 1] if n_chunks > 1 and last < CHUNK else [])
    entry = box(b"raw ", bytes(6), struct.pack(">HHHIHHHHI", 1, 0, 0, 0, 1, 8, 0, 0, RATE << 16))
    rate = struct.pack(">I", RATE)

    def file(base: int, wide: bool) -> bytes:
        """All but the payload, which begins at base."""
        starts = base + np.arange(n_chunks, dtype=np.int64) * (UNIT * CHUNK)
        tables = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            counted(b"stts", [n, UNIT], 2),
            counted(b"stss", np.arange(n_chunks, dtype=np.int64) * CHUNK + 1),
            counted(b"stsc", runs, 3),
            full(b"stsz", struct.pack(">II", UNIT, n)),
            counted(b"co64" if wide else b"stco", starts, 1, wide),
        )
        reference = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        info = box(b"minf", full(b"smhd", bytes(4)), reference, tables)
        handler = full(b"hdlr", bytes(4), b"soun", bytes(12), b"sound\0")
        media = box(b"mdia", _times(b"mdhd", rate, len(payload), struct.pack(">HH", 0x55C4, 0)), handler, info)
        volume = struct.pack(">HHHH", 0, 0, 0x100, 0)
        track = box(b"trak", _times(b"tkhd", struct.pack(">II", 1, 0), len(payload), bytes(8) + volume + _MATRIX + bytes(8), flags=7), media)
        movie = _times(b"mvhd", rate, len(payload), struct.pack(">IH", 0x10000, 0x100) + bytes(10) + _MATRIX + bytes(24) + struct.pack(">I", 2))
        data = struct.pack(">I4s", 8 + len(payload), b"mdat") if len(payload) < (1 << 32) - 8 else struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload))
        return box(b"ftyp", b"qt  ", bytes(4), b"qt  ") + box(b"moov", movie, track) + data

    head = len(file(0, False))
    wide = head + len(payload) >= 1 << 32
    head = len(file(0, True)) if wide else head
    return file(head, wide) + payload


def padded(raw: bytes) -> bytes:
    """raw with bytes 0 up to a positive multiple of UNIT."""
    return raw + bytes(-len(raw) % UNIT if raw else UNIT)


# --- reading


def boxes(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(kind, begin, end) of the contents of the boxes between at and end, and where the box itself begins."""
    while at < end:
        if end - at < 8:
            raise Fault("truncated")
        size, kind = struct.unpack_from(">I4s", data, at)
        begin = at + 8
        if size == 1:
            if end - at < 16:
                raise Fault("truncated")
            size, begin = struct.unpack_from(">Q", data, begin)[0], begin + 8
        elif size == 0:
            size = end - at
        if kind == b"uuid":
            begin += 16
        if at + size < begin:
            raise Fault("box_size")
        if at + size > end:
            raise Fault("truncated")
        yield kind, begin, at + size, at
        at += size


def walk(data: memoryview) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """boxes() with their paths, of the whole tree, parents first."""
    work = [((), boxes(data, 0, len(data)))]
    while work:
        path, rest = work[-1]
        found = next(rest, None)
        if found is None:
            work.pop()
            continue
        kind, begin, end, _ = found
        yield (*path, kind), *found[1:]
        if kind in HOLDERS:
            work.append(((*path, kind), boxes(data, begin, end)))


@dataclass
class Track:
    """What a track's boxes say; runs of samples as columns: first sample, samples, time, offset, bytes, sync."""

    track_id: int = 0
    handler: str = ""
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    width: int = 0
    height: int = 0
    channels: int = 0
    rate: int = 0
    samples: int = 0
    runs: list[np.ndarray] = field(default_factory=list)
    tables: dict[bytes, tuple[int, int]] = field(default_factory=dict)

    def joined(self) -> np.ndarray:
        """All runs, 6 columns; adjoining ones of one kind are one."""
        r = np.concatenate(self.runs) if self.runs else np.zeros((0, 6), np.int64)
        r = r[r[:, 1] > 0]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:, 5] != r[:-1, 5]) | (r[1:, 3] != r[:-1, 3] + r[:-1, 4]) | (r[1:, 0] != r[:-1, 0] + r[:-1, 1])
        at = np.flatnonzero(new)
        out = r[at]
        if len(at):
            out[:, 1], out[:, 4] = np.add.reduceat(r[:, 1], at), np.add.reduceat(r[:, 4], at)
        return out


def _numbers(data: memoryview, at: int, end: int, n: int, kind: str) -> np.ndarray:
    if n * np.dtype(kind).itemsize > end - at:
        raise Fault("table_truncated")
    return np.frombuffer(data, kind, n, at).astype(np.int64)


def _field(data: memoryview, form: str, at: int, end: int) -> tuple:
    if struct.calcsize(form) > end - at:
        raise Fault("table_truncated")
    return struct.unpack_from(form, data, at)


def _table(data: memoryview, track: Track, kind: bytes, width: int, number: str = ">u4") -> np.ndarray | None:
    if kind not in track.tables:
        return None
    at, end = track.tables[kind]
    (n,) = _field(data, ">I", at + 4, end)
    return _numbers(data, at + 8, end, n * width, number).reshape(n, width)


def _sizes(data: memoryview, track: Track) -> tuple[int, np.ndarray | None, int]:
    """(size of all samples, or 0; their sizes, or None; their number)."""
    if b"stsz" in track.tables:
        at, end = track.tables[b"stsz"]
        size, n = _field(data, ">II", at + 4, end)
        return (size, None, n) if size else (0, _numbers(data, at + 12, end, n, ">u4"), n)
    if b"stz2" in track.tables:
        at, end = track.tables[b"stz2"]
        bits, n = _field(data, ">II", at + 4, end)
        if bits & 255 == 4:
            packed = _numbers(data, at + 12, end, (n + 1) // 2, "u1")
            return 0, np.stack([packed >> 4, packed & 15], 1).ravel()[:n], n
        if bits & 255 not in (8, 16):
            raise Fault("sample_sizes")
        return 0, _numbers(data, at + 12, end, n, "u1" if bits & 255 == 8 else ">u2"), n
    return 0, None, 0


def _times_of(samples: np.ndarray, durations: np.ndarray | None) -> np.ndarray:
    """Decoding times of the samples with these numbers, from runs (samples, duration)."""
    if durations is None or not len(durations):
        return np.zeros(len(samples), np.int64)
    first = np.concatenate([[0], np.cumsum(durations[:, 0])])
    begin = np.concatenate([[0], np.cumsum(durations[:, 0] * durations[:, 1])])
    k = np.clip(np.searchsorted(first, samples, "right") - 1, 0, len(durations) - 1)
    return begin[k] + (samples - first[k]) * durations[k, 1]


def sample_runs(data: memoryview, track: Track) -> None:
    """Adds the runs that the sample tables tell."""
    size, sizes, n = _sizes(data, track)
    track.samples = n
    if not n:
        return
    chunks = _table(data, track, b"co64", 1, ">u8") if b"co64" in track.tables else _table(data, track, b"stco", 1)
    deal = _table(data, track, b"stsc", 3)
    if chunks is None or deal is None or not len(chunks) or not len(deal):
        raise Fault("sample_tables_missing")
    if deal[0, 0] != 1 or (np.diff(deal[:, 0]) <= 0).any():
        raise Fault("sample_tables_disagree")
    deal = deal[deal[:, 0] <= len(chunks)]
    each = np.repeat(deal[:, 1], np.diff(np.append(deal[:, 0], len(chunks) + 1)))
    first = np.concatenate([[0], np.cumsum(each)])  # of each chunk
    if first[-1] != n:
        raise Fault("sample_tables_disagree")
    sync = _table(data, track, b"stss", 1)
    # Runs begin with a chunk, with a sync sample and with what follows one.
    edges = [first[:-1][each > 0]]
    if sync is not None:
        sync = np.unique(sync.ravel()) - 1
        if len(sync) and (sync[0] < 0 or sync[-1] >= n):
            raise Fault("sample_tables_disagree")
        edges += [sync, sync[sync + 1 < n] + 1]
    begin = np.unique(np.concatenate(edges))
    many = np.diff(np.append(begin, n))
    chunk = np.searchsorted(first, begin, "right") - 1
    if sizes is None:
        offset, length = chunks[chunk, 0] + (begin - first[chunk]) * size, many * size
    else:
        before = np.concatenate([[0], np.cumsum(sizes)])
        offset, length = chunks[chunk, 0] + before[begin] - before[first[chunk]], before[begin + many] - before[begin]
    is_sync = np.ones(len(begin), bool) if sync is None else np.isin(begin, sync)
    time = _times_of(begin, _table(data, track, b"stts", 2))
    track.runs.append(np.stack([begin, many, time, offset, length, is_sync], 1))


def _header(data: memoryview, track: Track, kind: bytes, at: int, end: int) -> None:
    if kind == b"tkhd":
        wide = _field(data, ">B", at, end)[0] == 1
        (track.track_id,) = _field(data, ">I", at + (20 if wide else 12), end)
        track.width, track.height = (x >> 16 for x in _field(data, ">II", end - 8, end))
    elif kind == b"mdhd":
        wide = _field(data, ">B", at, end)[0] == 1
        track.timescale, track.duration = _field(data, ">IQ" if wide else ">II", at + (20 if wide else 12), end)
        track.duration = min(track.duration, (1 << 63) - 1)
    elif kind == b"hdlr":
        track.handler = _field(data, "4s", at + 8, end)[0].decode("latin-1")
    elif kind == b"stsd" and _field(data, ">I", at + 4, end)[0]:
        entry = next(boxes(data, at + 8, end), None)
        if entry is None:
            raise Fault("table_truncated")
        track.codec = entry[0].decode("latin-1")
        if track.handler == "soun" and entry[2] - entry[1] >= 28:
            track.channels, _, _, _, rate = struct.unpack_from(">HHHHI", data, entry[1] + 16)
            track.rate = rate >> 16
        elif track.handler == "vide" and entry[2] - entry[1] >= 28:
            track.width, track.height = struct.unpack_from(">HH", data, entry[1] + 24)
    track.tables.setdefault(kind, (at, end))


@dataclass
class Fragment:
    """A fragment of a track: defaults of its samples, and where its data begin."""

    track: Track | None
    base: int
    duration: int = 0
    size: int = 0
    flags: int = 0


def _fragment(data: memoryview, at: int, end: int, by_id: dict[int, Track], defaults: dict[int, tuple], moof: int, follow: int) -> Fragment:
    """follow: where the data of the fragment before end, 0 for the first one in moof."""
    version, track_id = _field(data, ">II", at, end)
    _, duration, size, flags = defaults.get(track_id, (0, 0, 0, 0))
    base = moof if version & FROM_MOOF or not follow else follow
    out, at = Fragment(by_id.get(track_id), base, duration, size, flags), at + 8
    if version & BASE:
        (out.base,), at = _field(data, ">Q", at, end), at + 8
    if version & DESCRIBED:
        at += 4
    for flag, name in ((LASTING, "duration"), (SIZED, "size"), (FLAGGED, "flags")):
        if version & flag:
            setattr(out, name, _field(data, ">I", at, end)[0])
            at += 4
    return out


def _fragment_runs(data: memoryview, at: int, end: int, part: Fragment, follow: int) -> int:
    """Adds the samples of a run to its track; where the next run's data begin if it doesn't say."""
    flags, n = _field(data, ">II", at, end)
    at, begin, first_flags = at + 8, follow, None
    if flags & FROM:
        (shift,), at = _field(data, ">i", at, end), at + 4
        begin = part.base + shift
    if flags & FIRST_FLAGS:
        (first_flags,), at = _field(data, ">I", at, end), at + 4
    columns = [f for f in (DURATIONS, SIZES, FLAGS, SHIFTS) if flags & f]
    rows = _numbers(data, at, end, n * len(columns), ">u4").reshape(n, len(columns))
    if part.track is None or not n:
        return begin
    if not columns:  # all alike, but perhaps for the first one's flags
        n_each = np.array([n] if first_flags is None else [1, n - 1], np.int64)
        steps, sizes, marks = n_each * part.duration, n_each * part.size, np.array([part.flags] if first_flags is None else [first_flags, part.flags])
    else:
        column = lambda f, default: rows[:, columns.index(f)] if f in columns else np.full(n, default, np.int64)
        steps, sizes, marks, n_each = column(DURATIONS, part.duration), column(SIZES, part.size), column(FLAGS, part.flags).copy(), np.ones(n, np.int64)
        if first_flags is not None:
            marks[0] = first_flags
    t = part.track
    before = lambda x: np.cumsum(x) - x
    t.runs.append(np.stack([t.samples + before(n_each), n_each, t.duration + before(steps), begin + before(sizes), sizes, marks & NOT_SYNC == 0], 1))
    t.samples, t.duration = t.samples + n, t.duration + int(steps.sum())
    return begin + int(sizes.sum())


def described(content: bytes) -> tuple[str, list[Track]]:
    """The brand and the tracks of a container; raises Fault."""
    data = memoryview(content)
    brand, tracks, by_id, defaults, n_boxes = "", [], {}, {}, 0
    part, moof, follow, movie = None, 0, 0, False
    for path, at, end, start in walk(data):
        kind, n_boxes = path[-1], n_boxes + 1
        if path == (b"ftyp",):
            brand = _field(data, "4s", at, end)[0].decode("latin-1")
        elif kind == b"trak":
            tracks.append(Track())
        elif len(path) > 2 and path[:2] == (b"moov", b"trak") and kind not in HOLDERS and path[2:] != (b"mdia", b"minf", b"hdlr"):
            _header(data, tracks[-1], kind, at, end)
        elif path[:-1] == (b"moov", b"mvex") and kind == b"trex":
            track_id, *rest = _field(data, ">5I", at + 4, end)
            defaults[track_id] = tuple(rest)
        elif kind == b"moof":
            by_id, moof, follow = {t.track_id: t for t in tracks}, start, 0
        elif kind == b"tfhd" and path[0] == b"moof":
            part = _fragment(data, at, end, by_id, defaults, moof, follow)
            follow = part.base
            for t in tracks:  # fragments go on after what the sample tables hold
                if b"" not in t.tables:
                    sample_runs(data, t)
                    t.tables[b""] = (0, 0)
        elif kind == b"trun" and part is not None:
            follow = _fragment_runs(data, at, end, part, follow)
        movie = movie or kind == b"moov"
    if not movie:
        raise Fault("no_movie" if n_boxes else "empty")
    for t in tracks:
        if b"" not in t.tables:
            sample_runs(data, t)
        r = t.joined()
        if len(r) and (r[:, 3].min() < 0 or (r[:, 3] + r[:, 4]).max() > len(data)):
            raise Fault("samples_outside")
    return brand, tracks


RANGE = "struct<sample: bigint, samples: bigint, time: bigint, offset: bigint, size: bigint>"
TRACK = f"struct<track_id: bigint, handler: string, codec: string, timescale: bigint, duration: bigint, width: int, height: int, channels: int, rate: int, samples: bigint, keyframes: array<{RANGE}>, extents: array<struct<offset: bigint, size: bigint>>>"


def _row(t: Track) -> dict:
    runs = t.joined()
    names = ("sample", "samples", "time", "offset", "size")
    out = {c: getattr(t, c) for c in ("track_id", "handler", "codec", "timescale", "duration", "width", "height", "channels", "rate", "samples")}
    out["keyframes"] = [dict(zip(names, r, strict=True)) for r in runs[runs[:, 5] == 1][:, :5].tolist()]
    t.runs = [np.concatenate([runs[:, :5], np.zeros((len(runs), 1), np.int64)], 1)]  # whatever they are, as byte ranges
    out["extents"] = [{"offset": a, "size": n} for a, n in t.joined()[:, 3:5].tolist()]
    return out


def read_columns(content: bytes | None) -> dict:
    """brand, tracks, fault of one container."""
    if content is None:
        return {"brand": None, "tracks": None, "fault": "null"}
    try:
        brand, tracks = described(content)
        return {"brand": brand, "tracks": [_row(t) for t in tracks], "fault": None}
    except Fault as e:
        return {"brand": None, "tracks": None, "fault": str(e)}


def media_columns(files: DataFrame, content: str = "content") -> DataFrame:
    """files with the columns brand, tracks and fault added (replaced where they are there).

    tracks has a row a track: handler, codec, timescale, duration (in units of the timescale), size of pictures, channels
    and rate, the number of samples, keyframes - byte ranges of samples that can be decoded by themselves, with their
    numbers and decoding times; adjoining ones are one range - and extents, the byte ranges of all samples.  A container that
    is null, empty, truncated or contradicts itself has a fault and null in place of columns.  Boxes that aren't known
    are passed over.  Repeated rows are read each; other columns pass untouched.
    """
    keep = [c for c in files.columns if c not in ("brand", "tracks", "fault")]
    source = files.select(*(F.col(f"`{c}`") for c in keep))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [read_columns(x) for x in b[content]]
            yield b.assign(**{c: pd.Series([x[c] for x in found], dtype=object, index=b.index) for c in ("brand", "tracks", "fault")})

    shape = source.withColumns({"brand": F.lit("x"), "tracks": F.lit(None).cast(f"array<{TRACK}>"), "fault": F.lit("x")}).schema
    for f in shape[-3:]:
        f.nullable = True
    return source.mapInPandas(run, shape)


def feature(found: dict) -> str:
    """A container's tracks in a line: codec, duration, samples and keyframe byte ranges of each; or its fault."""
    if found["fault"]:
        return f"fault={found['fault']}"
    tracks = (
        f"codec={t['codec'].strip()};duration={t['duration']}/{t['timescale']};samples={t['samples']};keyframes="
        + ",".join(f"{k['offset']}+{k['size']}" for k in t["keyframes"])
        for t in found["tracks"]
    )
    return "|".join(tracks)


def stored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, content) of each row: its text (null: empty) as UTF-8, padded, in a container of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts(batches, text):
            raw = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in b[text]]
            yield pd.DataFrame({key: b[key], "n_bytes": [len(x) for x in raw], "content": [container(padded(x)) for x in raw]})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, n_bytes long, content binary")


def op12_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a media file: written, read back by its sample tables and described."""
    files = cut(stored(table(spark, sf_dir, "documents").select("doc_id", "text")), "media")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for content in b["content"]:
                found = read_columns(content)
                payload = b"".join(content[x["offset"] : x["offset"] + x["size"]] for t in found["tracks"] or () for x in t["extents"])
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(content), hashlib.sha256(content).hexdigest(), feature(found)))
            names = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
            yield pd.concat([b[["doc_id", "n_bytes"]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return files.mapInPandas(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


#: The file is spelled out in hexadecimal, box by box; c chunks, r runs of chunks.
_SQL = f"""
WITH RECURSIVE steps AS (
    SELECT i AS byte, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
    UNION ALL
    SELECT byte, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
),
crc AS (SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8),
raw AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
sized AS (
    SELECT doc_id, raw, octet_length(raw) AS n_bytes, greatest({UNIT}, (octet_length(raw) + {UNIT} - 1) // {UNIT} * {UNIT}) AS p FROM raw
),
units AS (
    SELECT doc_id, n_bytes, p, raw || unhex(repeat('00', (p - n_bytes)::INT)) AS payload, p // {UNIT} AS n, (p // {UNIT} + {CHUNK} - 1) // {CHUNK} AS c FROM sized
),
laid AS (
    SELECT *, n - {CHUNK} * (c - 1) AS last, CASE WHEN c > 1 AND n % {CHUNK} > 0 THEN 2 ELSE 1 END AS r FROM units
),
based AS (SELECT *, 506 + 8 * c + 12 * r AS moov, 534 + 8 * c + 12 * r AS base FROM laid),
headed AS (
    SELECT *, concat(
        '00000014', hex('ftypqt  '), '00000000', hex('qt  '),
        printf('%08x', moov), hex('moov'),
        '0000006c', hex('mvhd'), repeat('00', 12), '{RATE:08x}', printf('%08x', p), '000100000100', repeat('00', 10),
        '00010000', repeat('00', 12), '00010000', repeat('00', 12), '40000000', repeat('00', 24), '00000002',
        printf('%08x', moov - 116), hex('trak'),
        '0000005c', hex('tkhd'), '00000007', repeat('00', 8), '0000000100000000', printf('%08x', p), repeat('00', 12), '01000000',
        '00010000', repeat('00', 12), '00010000', repeat('00', 12), '40000000', repeat('00', 8),
        printf('%08x', moov - 216), hex('mdia'),
        '00000020', hex('mdhd'), repeat('00', 12), '{RATE:08x}', printf('%08x', p), '55c40000',
        '00000026', hex('hdlr'), repeat('00', 8), hex('soun'), repeat('00', 12), hex('sound'), '00',
        printf('%08x', moov - 294), hex('minf'), '00000010', hex('smhd'), repeat('00', 8),
        '00000024', hex('dinf'), '0000001c', hex('dref'), '0000000000000001', '0000000c', hex('url '), '00000001',
        printf('%08x', moov - 354), hex('stbl'),
        '00000034', hex('stsd'), '0000000000000001', '00000024', hex('raw '), repeat('00', 6), '0001', repeat('00', 8), '0001000800000000', '{RATE << 16:08x}',
        '00000018', hex('stts'), '0000000000000001', printf('%08x', n), '{UNIT:08x}',
        printf('%08x', 16 + 4 * c), hex('stss'), '00000000', printf('%08x', c), array_to_string(list_transform(range(c), lambda i: printf('%08x', {CHUNK} * i + 1)), ''),
        printf('%08x', 16 + 12 * r), hex('stsc'), '00000000', printf('%08x', r), '00000001', printf('%08x', least(n, {CHUNK})), '00000001',
        CASE WHEN r = 2 THEN printf('%08x%08x00000001', c, last) ELSE '' END,
        '00000014', hex('stsz'), '00000000', '{UNIT:08x}', printf('%08x', n),
        printf('%08x', 16 + 4 * c), hex('stco'), '00000000', printf('%08x', c), array_to_string(list_transform(range(c), lambda i: printf('%08x', base + {UNIT * CHUNK} * i)), ''),
        printf('%08x', p + 8), hex('mdat')
    ) AS head FROM based
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, p::BIGINT AS payload_bytes, sha256(payload) AS payload_sha256,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, {UNIT}),
        lambda i: ('0x' || substr(right(hex(payload), {2 * UNIT}), (2 * i + 1)::INT, 2))::BIGINT)),
        lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])))::BIGINT AS tail_crc32,
    (length(head) // 2 + p)::BIGINT AS media_bytes, sha256(unhex(head) || payload) AS media_sha256,
    concat('codec=raw;duration=', p, '/{RATE};samples=', n, ';keyframes=',
        array_to_string(list_transform(range(c), lambda i: concat(base + {UNIT * CHUNK} * i, '+{UNIT}')), ',')) AS feature
FROM headed, crc
"""

QUERIES = {"op12_media_columns": op12_media_columns}
ORACLE: dict[str, str] = {"op12_media_columns": _SQL}
