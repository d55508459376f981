"""Keyed containers: block-compressed files of keys and records, read as a Spark data source.

A container has a header (attributes), blocks of sorted keys with the offset of each record, and blocks of records.  The
planning step reads the header and the two block directories only; a partition is a run of key blocks and reads just the
record blocks that its keys point into.  Files are opened through Arrow's file systems, so local and remote paths work.
Blocks may be stored or deflated; containers with scrambled directories or another compression are refused.

    spark.read.format("keyed_container").load("words.mdx")      -> ordinal, key, value
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from glyphmill.sources.files import opened

SCHEMA = "ordinal bigint, key string, value binary"
STORED, DEFLATED = b"\0\0\0\0", b"\2\0\0\0"


@dataclass(frozen=True)
class KeyBlock:
    entries: int
    at: int
    size: int


@dataclass
class Directory:
    """Where everything is: what planning reads of a container."""

    attributes: dict[str, str]
    wide: bool
    encoding: str
    keys: list[KeyBlock]
    records_at: int
    records: list[tuple[int, int]]

    @property
    def entries(self) -> int:
        return sum(b.entries for b in self.keys)


def _read(f: BinaryIO, n: int) -> bytes:
    out = f.read(n)
    if len(out) != n:
        raise ValueError("container ends too early")
    return out


def unpacked(block: bytes) -> bytes:
    """Content of a block: a mark of its compression, a checksum, data."""
    kind, check, data = block[:4], struct.unpack(">I", block[4:8])[0], block[8:]
    if kind not in (STORED, DEFLATED):
        raise ValueError(f"unsupported compression of a block: {kind!r}")
    content = zlib.decompress(data) if kind == DEFLATED else data
    if zlib.adler32(content) != check:
        raise ValueError("damaged block")
    return content


def directory(f: BinaryIO) -> Directory:
    size = struct.unpack(">I", _read(f, 4))[0]
    head = _read(f, size)
    if zlib.adler32(head) != struct.unpack("<I", _read(f, 4))[0]:
        raise ValueError("not a keyed container")
    attributes = dict(re.findall(r'(\w+)="(.*?)"', head.decode("utf-16-le").rstrip("\0"), re.S))
    wide = float(attributes.get("GeneratedByEngineVersion", "2.0")) >= 2.0
    if attributes.get("Encrypted", "0") not in ("", "0", "No"):
        raise ValueError("scrambled containers can't be read")
    encoding = attributes.get("Encoding", "") or "UTF-16"
    encoding = {"UTF-16": "utf-16-le", "GBK": "gb18030", "GB2312": "gb18030"}.get(encoding.upper(), encoding.lower())
    number, width = (">Q", 8) if wide else (">I", 4)
    numbers = lambda n: [struct.unpack(number, _read(f, width))[0] for _ in range(n)]
    n_blocks, _, *rest = numbers(5 if wide else 4)
    info_size, keys_size = rest[-2:]
    if wide:
        _read(f, 4)  # checksum of the numbers
    info = _read(f, info_size)
    at = f.tell()
    keys = _key_blocks(unpacked(info) if wide else info, n_blocks, wide, encoding, at)
    f.seek(at + keys_size)
    n_records, _, _, _ = numbers(4)
    records = [tuple(numbers(2)) for _ in range(n_records)]
    return Directory(attributes, wide, encoding, keys, f.tell(), records)


def _key_blocks(info: bytes, n: int, wide: bool, encoding: str, at: int) -> list[KeyBlock]:
    number, width = (">Q", 8) if wide else (">I", 4)
    unit = 2 if encoding.startswith("utf-16") else 1
    out, p = [], 0
    for _ in range(n):
        entries = struct.unpack_from(number, info, p)[0]
        p += width
        for _ in range(2):  # the first and the last key
            length = struct.unpack_from(">H" if wide else ">B", info, p)[0]
            p += (2 if wide else 1) + (length + wide) * unit
        size = struct.unpack_from(number, info, p)[0]
        p += 2 * width
        out.append(KeyBlock(entries, at, size))
        at += size
    return out


def _keys(f: BinaryIO, where: Directory, block: KeyBlock) -> Iterator[tuple[int, str]]:
    """(offset of the record, key) of a key block."""
    f.seek(block.at)
    raw = unpacked(_read(f, block.size))
    number, width = (">Q", 8) if where.wide else (">I", 4)
    unit, p = 2 if where.encoding.startswith("utf-16") else 1, 0
    for _ in range(block.entries):
        offset = struct.unpack_from(number, raw, p)[0]
        p = stop = p + width
        while raw[stop : stop + unit] != b"\0" * unit:
            stop = raw.find(b"\0", stop) if unit == 1 else stop + 2
            if stop < 0 or stop >= len(raw):
                raise ValueError("a key has no end")
        yield offset, raw[p:stop].decode(where.encoding)
        p = stop + unit


class _Records:
    """Record bytes by their offsets in the whole; the last block is kept."""

    def __init__(self, f: BinaryIO, where: Directory):
        self.f, self.blocks, self.held = f, [], (-1, b"")
        at, start = where.records_at, 0
        for size, content in where.records:
            self.blocks.append((start, start + content, at, size))
            at, start = at + size, start + content
        self.total = start

    def __call__(self, start: int, stop: int) -> bytes:
        from bisect import bisect_right

        out, i = [], bisect_right(self.blocks, start, key=lambda b: b[0]) - 1
        while start < stop:
            first, last, at, size = self.blocks[i]
            if self.held[0] != i:
                self.f.seek(at)
                self.held = (i, unpacked(_read(self.f, size)))
            out.append(self.held[1][start - first : stop - first])
            start, i = last, i + 1
        return b"".join(out)


@dataclass
class Run(InputPartition):
    path: str
    first: int
    last: int
    ordinal: int


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], per_run: int):
        self.paths, self.per_run = paths, per_run

    def partitions(self) -> list[Run]:
        out = []
        for path in self.paths:
            with opened(path) as f:
                where = directory(f)
            first = entries = done = 0
            for i, block in enumerate(where.keys):
                entries += block.entries
                if entries >= self.per_run or i + 1 == len(where.keys):
                    out.append(Run(path, first, i + 1, done + 1))
                    first, done, entries = i + 1, done + entries, 0
        return out or [Run("", 0, 0, 1)]

    def read(self, run: Run) -> Iterator[tuple]:
        if not run.path:
            return
        with opened(run.path) as f:
            where = directory(f)
            get = _Records(f, where)
            end = next(_keys(f, where, where.keys[run.last]))[0] if run.last < len(where.keys) else get.total
            found = [x for b in where.keys[run.first : run.last] for x in _keys(f, where, b)]
            stops = [offset for offset, _ in found[1:]] + [end]
            for i, ((offset, key), stop) in enumerate(zip(found, stops, strict=True)):
                yield run.ordinal + i, key, get(offset, stop)


class KeyedContainer(DataSource):
    """Options: path (several with commas), entries_per_partition."""

    @classmethod
    def name(cls) -> str:
        return "keyed_container"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader([p for p in self.options["path"].split(",") if p], int(self.options.get("entries_per_partition", "20000")))


def read(spark: SparkSession, *paths: str, entries_per_partition: int = 20_000):
    """(ordinal, key, value) of containers; ordinals count from 1 in each."""
    spark.dataSource.register(KeyedContainer)
    return spark.read.format("keyed_container").option("entries_per_partition", entries_per_partition).load(",".join(paths))


def attributes(path: str) -> dict[str, str]:
    """Header attributes of a container, and how many entries it has."""
    with opened(path) as f:
        where = directory(f)
    return {**where.attributes, "entries": str(where.entries)}
