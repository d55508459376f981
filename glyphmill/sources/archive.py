"""ZIP archives as a Spark data source, read and written by many tasks.

Reading.  Planning reads the end of a file and its central directory, by ranges; a partition is a run of directory entries of
about `bytes_per_partition` stored bytes, and its task reads the bytes of its own members, one at a time, and nothing else.
Names, sizes and checksums come from the directory alone (`content` false).

Writing.  Each task deflates its members, by name, into a part beside the target and tells where that is; the commit merges
the finished streams of the parts in the order of their names, with fixed times and modes, and appends the directory, which
grows in a file, too.  So the file depends on names and contents only - not on how rows were dealt out - and neither the
driver nor any task holds more than one member and a stretch of each part.  Archives of 65,535 members or 4 GB and more get
the long fields that these take, others none.  Parts of tasks that were lost or run twice are never looked at, and go with
the folder.

    spark.read.format("zip_members").load("a.zip")       -> path, name, place, size, stored, crc, content
    df.write.format("zip_members").mode("overwrite").save("b.zip")      from name, content
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from glyphmill.sources.files import created, dropped, folder, moved, opened

SCHEMA = "path string, name string, place bigint, size bigint, stored bigint, crc bigint, content binary"
#: Stored bytes of a partition's members.
RUN_BYTES = 32 << 20
_CHUNK = 1 << 20
#: What a commit holds of all parts together, and of the directory at a time.
_HELD = 64 << 20

# Fixed values of the format: marks of its records, fixed parts, methods, flags, and the largest values of short fields.
_LOCAL, _ENTRY, _END, _END64, _AT64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
_LOCAL_PART, _ENTRY_PART, _END_PART, _END64_PART = struct.Struct("<4s5H3I2H"), struct.Struct("<4s6H3I5H2I"), struct.Struct("<4s4H2IH"), struct.Struct("<4sQ2H2I4Q")
_AT64_PART, _MEMBER = struct.Struct("<4sIQI"), struct.Struct("<HIQQ")
_STORED, _DEFLATED, _SCRAMBLED, _UTF8 = 0, 8, 1, 0x800
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
#: The first day that a date can be, and a regular file that all may read.
_DATE, _MODE, _UNIX = 0x21, 0o644 << 16, 3 << 8 | 20


@dataclass(frozen=True)
class Entry:
    name: str
    method: int
    flags: int
    crc: int
    stored: int
    size: int
    at: int


def _exact(f: BinaryIO, at: int, n: int) -> bytes:
    f.seek(at)
    out = f.read(n)
    if len(out) != n:
        raise ValueError("archive ends too early")
    return out


def _directory(f: BinaryIO) -> tuple[int, int, int]:
    """Where the central directory begins, its bytes and its entries."""
    f.seek(0, os.SEEK_END)
    total = f.tell()
    tail = _exact(f, max(0, total - _END_PART.size - _FULL16), min(total, _END_PART.size + _FULL16))
    at = tail.rfind(_END)
    if at < 0 or len(tail) - at < _END_PART.size:
        raise ValueError("not an archive")
    _, _, _, _, n, size, begin, _ = _END_PART.unpack_from(tail, at)
    end = total - len(tail) + at
    if _FULL16 in (n,) or _FULL32 in (size, begin):
        if end < 20 or (mark := _exact(f, end - 20, 20))[:4] != _AT64:
            raise ValueError("a long archive without the record that says where its directory is")
        where = struct.unpack_from("<Q", mark, 8)[0]
        *_, n, size, begin = _END64_PART.unpack(_exact(f, where, _END64_PART.size))
    return begin, size, n


def _entries(raw: bytes) -> Iterator[Entry]:
    """The entries of a central directory, or of a part of it."""
    at = 0
    while at < len(raw):
        if len(raw) - at < _ENTRY_PART.size or raw[at : at + 4] != _ENTRY:
            raise ValueError("damaged directory")
        _, _, _, flags, method, _, _, crc, stored, size, n_name, n_extra, n_note, _, _, _, offset = _ENTRY_PART.unpack_from(raw, at)
        at += _ENTRY_PART.size
        name = raw[at : at + n_name].decode("utf-8" if flags & _UTF8 else "cp437")
        extra, at = raw[at + n_name : at + n_name + n_extra], at + n_name + n_extra + n_note
        while len(extra) >= 4:  # long values stand in an extra field, those that don't fit only
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                longs = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                size, stored, offset = (next(longs) if v == _FULL32 else v for v in (size, stored, offset))
            extra = extra[4 + n :]
        yield Entry(name, method, flags, crc, stored, size, offset)


def _content(f: BinaryIO, e: Entry) -> bytes:
    """A member's bytes, inflated and checked."""
    if e.flags & _SCRAMBLED or e.method not in (_STORED, _DEFLATED):
        raise ValueError(f"a member that can't be read: {e.name}")
    head = _LOCAL_PART.unpack(_exact(f, e.at, _LOCAL_PART.size))
    if head[0] != _LOCAL:
        raise ValueError(f"damaged member: {e.name}")
    raw = _exact(f, e.at + _LOCAL_PART.size + head[-2] + head[-1], e.stored)
    if e.method == _DEFLATED:
        unpack = zlib.decompressobj(-15)
        raw = unpack.decompress(raw, e.size + 1)
    if len(raw) != e.size or zlib.crc32(raw) != e.crc:
        raise ValueError(f"damaged member: {e.name}")
    return raw


@dataclass
class Run(InputPartition):
    """Bytes begin to end of a directory, whose first entry is number `place`."""

    path: str
    begin: int
    end: int
    place: int


def _entry_runs(f: BinaryIO, begin: int, size: int) -> Iterator[tuple[bytes, int]]:
    """The entries of a directory as bytes, and where each ends in it; a chunk of it is held at a time."""
    raw, at, end = b"", 0, 0
    while end < size:
        here = len(raw) - at
        need = _ENTRY_PART.size + (sum(struct.unpack_from("<3H", raw, at + 28)) if here >= _ENTRY_PART.size else 0)
        if here < need:
            if end + here == size:
                raise ValueError("damaged directory")
            raw, at = raw[at:] + _exact(f, begin + end + here, min(_CHUNK, size - end - here)), 0
            continue
        at, end = at + need, end + need
        yield raw[at - need : at], end


def runs(path: str, per_run: int) -> list[Run]:
    """The partitions of an archive; its members aren't touched."""
    out, first, end, place, n, stored = [], 0, 0, 0, 0, 0
    with opened(path) as f:
        begin, size, _ = _directory(f)
        for raw, end in _entry_runs(f, begin, size):
            n, stored = n + 1, stored + next(_entries(raw)).stored
            if stored >= per_run:
                out.append(Run(path, begin + first, begin + end, place))
                first, place, stored = end, n, 0
    return [*out, Run(path, begin + first, begin + end, place)] if end > first else out


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["path"].split(",") if p]
        self.per_run = int(options.get("bytes_per_partition", RUN_BYTES))
        self.wanted = re.compile(options.get("names", ".*"), re.S)
        self.whole = options.get("content", "true").lower() != "false"

    def partitions(self) -> list[Run]:
        return [r for p in self.paths for r in runs(p, self.per_run)] or [Run("", 0, 0, 0)]

    def read(self, run: Run) -> Iterator[tuple]:
        if not run.path:
            return
        with opened(run.path) as f:
            for i, e in enumerate(_entries(_exact(f, run.begin, run.end - run.begin))):
                if self.wanted.fullmatch(e.name):
                    yield run.path, e.name, run.place + i, e.size, e.stored, e.crc, _content(f, e) if self.whole else None


@dataclass
class Written(WriterCommitMessage):
    """A task's part: its members by name, each a fixed head, its name and its stream."""

    part: str


class _Part:
    """A part that is read from its begin to its end, a stretch at a time; it is open only while a stretch is read."""

    def __init__(self, path: str, stretch: int):
        self.path, self.stretch, self.at, self.held = path, stretch, 0, b""

    def read(self, n: int) -> bytes:
        """The next n bytes; fewer at the end."""
        if len(self.held) < n:
            with opened(self.path) as f:
                f.seek(self.at)
                more = f.read(max(self.stretch, n - len(self.held)))
            self.at += len(more)
            self.held += more
        out, self.held = self.held[:n], self.held[n:]
        return out

    def members(self) -> Iterator[tuple[bytes, str, int, int, int, _Part]]:
        """(name, path, checksum, stored bytes, bytes, this); the stream is to be read before the next member is asked for."""
        while head := self.read(_MEMBER.size):
            n, crc, stored, size = _MEMBER.unpack(head)
            yield self.read(n), self.path, crc, stored, size, self


def _entry(name: bytes, crc: int, stored: int, size: int, at: int) -> bytes:
    """A member's entry of the directory; what lies beyond 4 GB is told by a long field."""
    flags, far = 0 if name.isascii() else _UTF8, at >= _FULL32
    extra, needs = (struct.pack("<HHQ", 1, 8, at), 45) if far else (b"", 20)
    fixed = _ENTRY_PART.pack(_ENTRY, _UNIX, needs, flags, _DEFLATED, 0, _DATE, crc, stored, size, len(name), len(extra), 0, 0, 0, _MODE, _FULL32 if far else at)
    return fixed + name + extra


def _end(n: int, size: int, begin: int) -> bytes:
    """The end of an archive, with a long one before it where its values don't fit."""
    short = _END_PART.pack(_END, 0, 0, min(n, _FULL16), min(n, _FULL16), min(size, _FULL32), min(begin, _FULL32), 0)
    if n < _FULL16 and max(size, begin) < _FULL32:
        return short
    long = _END64_PART.pack(_END64, _END64_PART.size - 12, 45, 45, 0, 0, n, n, size, begin)
    return long + _AT64_PART.pack(_AT64, 0, begin + size, 1) + short


class _Writer(DataSourceWriter):
    """Writes rows that are sorted by name within each task."""

    def __init__(self, path: str):
        self.path, self.parts = path, f"{path}.parts-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        part = f"{self.parts}/{uuid.uuid4().hex}"
        folder(self.parts)
        with created(part) as f:
            for r in rows:
                name, raw = r["name"].encode(), bytes(r["content"] or b"")
                pack = zlib.compressobj(9, zlib.DEFLATED, -15)
                pieces = [pack.compress(raw[k : k + _CHUNK]) for k in range(0, len(raw), _CHUNK)] + [pack.flush()]
                f.write(_MEMBER.pack(len(name), zlib.crc32(raw), sum(map(len, pieces)), len(raw)) + name)
                for piece in pieces:
                    f.write(piece)
        return Written(part)

    def commit(self, messages: list[Written | None]) -> None:
        parts = sorted(m.part for m in messages if m is not None)
        stretch = max(1 << 12, min(_CHUNK, _HELD // max(1, len(parts))))
        folder(self.parts)
        last, n, at, whole, entries = None, 0, 0, f"{self.parts}/archive", f"{self.parts}/directory"
        with created(whole) as out:
            with created(entries) as listed:
                for name, _, crc, stored, size, part in heapq.merge(*(_Part(p, stretch).members() for p in parts)):
                    if name == last:
                        raise ValueError(f"two members of one name: {name.decode()}")
                    flags = 0 if name.isascii() else _UTF8
                    out.write(_LOCAL_PART.pack(_LOCAL, 20, flags, _DEFLATED, 0, _DATE, crc, stored, size, len(name), 0) + name)
                    for k in range(0, stored, _CHUNK):
                        out.write(part.read(min(_CHUNK, stored - k)))
                    listed.write(_entry(name, crc, stored, size, at))
                    last, n, at = name, n + 1, at + _LOCAL_PART.size + len(name) + stored
            n_listed = 0
            with opened(entries) as listed:
                while piece := listed.read(_CHUNK):
                    out.write(piece)
                    n_listed += len(piece)
            out.write(_end(n, n_listed, at))
        moved(whole, self.path)
        dropped(self.parts)

    def abort(self, messages: list[Written | None]) -> None:
        dropped(self.parts)


class ZipMembers(DataSource):
    """Options for reading: path (several with commas), names (a pattern that whole names match), content (false: none is
    read), bytes_per_partition."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def members(spark: SparkSession, *paths: str, names: str = ".*", content: bool = True, bytes_per_partition: int = RUN_BYTES) -> DataFrame:
    """(path, name, place, size, stored, crc, content) of archives' members; place counts from 0 in the order of the
    directory.  Without content (null then) only directories are read.  Damaged and scrambled members fail the query."""
    spark.dataSource.register(ZipMembers)
    read = spark.read.format("zip_members").option("names", names).option("content", str(content).lower())
    return read.option("bytes_per_partition", bytes_per_partition).load(",".join(paths))


def write(files: DataFrame, path: str) -> None:
    """Write the rows (name, content) of files as one archive, in the order of their names.  A null content is empty; two
    rows of one name fail and leave what was there."""
    files.sparkSession.dataSource.register(ZipMembers)
    folder(path.rpartition("/")[0] or ".")
    rows = files.select("name", F.col("content").cast("binary").alias("content")).sortWithinPartitions("name")
    rows.write.format("zip_members").mode("overwrite").save(path)
