"""Keyed containers for tests."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable

from glyphmill.sources.container import DEFLATED, STORED


def packed(content: bytes, deflate: bool = True) -> bytes:
    return (DEFLATED if deflate else STORED) + struct.pack(">I", zlib.adler32(content)) + (zlib.compress(content) if deflate else content)


def build(rows: Iterable[tuple[str, bytes]], encoding: str = "UTF-8", wide: bool = True, per_block: int = 1000, record_block: int = 1 << 16, deflate: bool = True, **attributes: str) -> bytes:
    """A container of (key, record) rows in their order."""
    rows = list(rows)
    codec, unit = ("utf-16-le", 2) if encoding == "UTF-16" else (encoding.lower(), 1)
    number = ">Q" if wide else ">I"
    pack = lambda *values: b"".join(struct.pack(number, v) for v in values)
    given = {"GeneratedByEngineVersion": "2.0" if wide else "1.2", "Encoding": encoding, "Encrypted": "0", **attributes}
    head = ("<Container " + " ".join(f'{k}="{v}"' for k, v in given.items()) + "/>\r\n\0").encode("utf-16-le")
    info, keys, offset = b"", [], 0
    for at in range(0, len(rows), per_block):
        some = rows[at : at + per_block]
        content = b""
        for key, record in some:
            content += pack(offset) + key.encode(codec) + b"\0" * unit
            offset += len(record)
        keys.append(packed(content, deflate))
        info += pack(len(some))
        for key in (some[0][0], some[-1][0]):
            raw = key.encode(codec)
            info += struct.pack(">H" if wide else ">B", len(raw) // unit) + raw + b"\0" * unit * wide
        info += pack(len(keys[-1]), len(content))
    whole = b"".join(record for _, record in rows)
    blocks = [whole[i : i + record_block] for i in range(0, len(whole), record_block)]
    stored = [packed(b, deflate) for b in blocks]
    listed = packed(info) if wide else info
    sizes = pack(len(keys), len(rows), *([len(info)] if wide else []), len(listed), sum(map(len, keys)))
    out = struct.pack(">I", len(head)) + head + struct.pack("<I", zlib.adler32(head)) + sizes
    out += struct.pack(">I", zlib.adler32(sizes)) if wide else b""
    out += listed + b"".join(keys)
    directory_ = pack(*(x for s, b in zip(stored, blocks, strict=True) for x in (len(s), len(b))))
    return out + pack(len(stored), len(rows), len(directory_), sum(map(len, stored))) + directory_ + b"".join(stored)
