"""Images: whether a file is what its name says, and PNG files from other kinds.

The kinds that stay are checked by their structure.  Uncompressed bitmaps are turned into PNG here; what needs a drawing
library (vector graphics, TIFF, compressed bitmaps) goes through the one that is installed, if any, and is `unsupported`
otherwise.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PNG_MARK = b"\x89PNG\r\n\x1a\n"


def _png_is_whole(raw: bytes) -> bool:
    """Signature, checksums of all chunks, a header first and an end."""
    at, kinds = len(PNG_MARK), []
    while raw.startswith(PNG_MARK) and at + 12 <= len(raw):
        size, kind = struct.unpack_from(">I4s", raw, at)
        body = raw[at + 4 : at + 8 + size]
        if at + 12 + size > len(raw) or zlib.crc32(body) != struct.unpack_from(">I", raw, at + 8 + size)[0]:
            return False
        kinds.append(kind)
        at += 12 + size
        if kind == b"IEND":
            return kinds[0] == b"IHDR"
    return False


#: What a whole file of each kind looks like.
WHOLE: dict[str, Callable[[bytes], bool]] = {
    ".png": _png_is_whole,
    ".jpg": lambda raw: raw.startswith(b"\xff\xd8\xff") and b"\xff\xd9" in raw[-64:],
    ".jpeg": lambda raw: WHOLE[".jpg"](raw),
    ".gif": lambda raw: raw[:6] in (b"GIF87a", b"GIF89a") and len(raw) > 13 and raw.rstrip(b"\0").endswith(b";"),
    ".webp": lambda raw: raw[:4] == b"RIFF" and raw[8:12] == b"WEBP" and struct.unpack_from("<I", raw, 4)[0] + 8 <= len(raw) + 1,
}


def png(pixels: np.ndarray) -> bytes:
    """A PNG file of (rows, columns, 3 or 4) bytes."""
    height, width, channels = pixels.shape
    lines = np.zeros((height, 1 + width * channels), np.uint8)  # each line begins with filter 0
    lines[:, 1:] = pixels.reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 6, 0, 0, 0)
    return PNG_MARK + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 9)) + chunk(b"IEND", b"")


def bitmap(raw: bytes) -> np.ndarray | None:
    """The pixels of an uncompressed bitmap of 8 (with a palette), 24 or 32 bits; None for other kinds, ValueError for a
    damaged file."""
    if raw[:2] != b"BM" or len(raw) < 54:
        raise ValueError("not a bitmap")
    start = struct.unpack_from("<I", raw, 10)[0]
    head, width, height, _, depth, packed = struct.unpack_from("<IiiHHI", raw, 14)
    if packed or depth not in (8, 24, 32) or head < 40:
        return None
    rows, stride = abs(height), (width * depth // 8 + 3) // 4 * 4
    if width <= 0 or not rows or start + rows * stride > len(raw):
        raise ValueError("truncated bitmap")
    lines = np.frombuffer(raw, np.uint8, rows * stride, start).reshape(rows, stride)[:, : width * depth // 8]
    if depth == 8:
        n = struct.unpack_from("<I", raw, 46)[0] or 256
        palette = np.zeros((256, 4), np.uint8)
        palette[:n] = np.frombuffer(raw, np.uint8, 4 * n, 14 + head).reshape(n, 4)
        pixels = palette[lines][:, :, 2::-1]
    else:
        pixels = lines.reshape(rows, width, depth // 8)[:, :, 2::-1]
    return pixels[::-1] if height > 0 else pixels


def _drawn(raw: bytes, ext: str) -> bytes | None:
    """PNG by an installed library; None if there is none for the kind."""
    try:
        if ext == ".svg":
            from cairosvg import svg2png

            return svg2png(bytestring=raw)
        from PIL import Image
    except ImportError:
        return None
    out = io.BytesIO()
    with Image.open(io.BytesIO(raw)) as image:
        image.save(out, format="PNG", optimize=False)
    return out.getvalue()


def normalize(raw: bytes, ext: str) -> tuple[str, bytes | None, str]:
    """(status, content, extension) of one file: kept, unreadable or unsupported."""
    if ext in WHOLE:
        return ("kept", raw, ".jpg" if ext == ".jpeg" else ext) if WHOLE[ext](raw) else ("unreadable", None, ext)
    try:
        pixels = bitmap(raw) if ext == ".bmp" else None
        content = png(pixels) if pixels is not None else _drawn(raw, ext)
    except Exception:  # whatever a decoder makes of a damaged file
        return "unreadable", None, ext
    return ("kept", content, ".png") if content is not None else ("unsupported", None, ext)


def normalized(content: Column, ext: Column) -> Column:
    """STRUCT<status, content, ext> of each image; null for null."""

    @F.pandas_udf("status string, content binary, ext string")
    def run(contents: pd.Series, exts: pd.Series) -> pd.DataFrame:
        rows = [normalize(bytes(c), e) if c is not None and isinstance(e, str) else (None, None, None) for c, e in zip(contents, exts, strict=True)]
        return pd.DataFrame(rows, columns=["status", "content", "ext"], dtype=object)

    return run(content, ext)
