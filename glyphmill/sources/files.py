"""Files by path or address, through Arrow's file systems: local and remote ones alike."""

from __future__ import annotations

import ctypes
import hashlib
import re
from collections.abc import Iterator
from typing import BinaryIO


def placed(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*://|file:", path) else (fs.LocalFileSystem(), path)


def opened(path: str) -> BinaryIO:
    """A file that can be read anywhere."""
    system, inside = placed(path)
    return system.open_input_file(inside)


def created(path: str) -> BinaryIO:
    """A new file, in place of one that is there."""
    system, inside = placed(path)
    return system.open_output_stream(inside)


def folder(path: str) -> None:
    system, inside = placed(path)
    system.create_dir(inside, recursive=True)


def moved(path: str, to: str) -> None:
    """Give a file another name of the same file system, in place of a file that has it."""
    from pyarrow import fs

    system, inside = placed(path)
    target = placed(to)[1]
    if not isinstance(system, fs.LocalFileSystem) and system.get_file_info(target).type == fs.FileType.File:
        system.delete_file(target)  # a local one is replaced by the move itself
    system.move(inside, target)


def dropped(path: str) -> None:
    """Remove a folder and all in it, if it is there."""
    from pyarrow import fs

    system, inside = placed(path)
    if system.get_file_info(inside).type == fs.FileType.Directory:
        system.delete_dir(inside)


def digest(path: str, part: int = 1 << 22) -> tuple[int, str]:
    """Bytes and SHA-256 of a file, a part at a time."""
    found, n = hashlib.sha256(), 0
    with opened(path) as f:
        while piece := f.read(part):
            found.update(piece)
            n += len(piece)
    return n, found.hexdigest()


def _sha256_of_library() -> ctypes.CDLL | None:
    """The library that Python's own hashlib calls, where it has SHA-256 with a state that can be copied as bytes."""
    try:
        import _hashlib

        found = ctypes.CDLL(_hashlib.__file__)
        found.SHA256_Init.argtypes = [ctypes.c_char_p]
        found.SHA256_Update.argtypes = [ctypes.c_char_p, ctypes.c_char_p, ctypes.c_size_t]
        found.SHA256_Final.argtypes = [ctypes.c_char_p, ctypes.c_char_p]
    except (ImportError, OSError, AttributeError):
        return None
    return found


_SHA256 = _sha256_of_library()
#: Whether a Sha256 can be put aside.
RESUMABLE = _SHA256 is not None


class Sha256:
    """A SHA-256 that can be put aside as bytes (its state) and gone on with in another process of the same kind of machine."""

    def __init__(self, state: bytes | None = None):
        self._context = ctypes.create_string_buffer(state or b"", 256)  # what the library keeps takes 112 bytes
        if state is None:
            _SHA256.SHA256_Init(self._context)

    def update(self, data: bytes) -> None:
        _SHA256.SHA256_Update(self._context, data, len(data))

    def state(self) -> bytes:
        return self._context.raw

    def hexdigest(self) -> str:
        out, copy = ctypes.create_string_buffer(32), ctypes.create_string_buffer(self._context.raw, 256)
        _SHA256.SHA256_Final(out, copy)
        return out.raw.hex()


def ranged(path: str, start: int, size: int, part: int = 1 << 22) -> Iterator[bytes]:
    """The bytes of a range of a file, a part at a time; a file that ends before it is an error."""
    with opened(path) as f:
        f.seek(start)
        while size:
            piece = f.read(min(size, part))
            if not piece:
                raise EOFError(f"{path} is shorter than it was listed")
            size -= len(piece)
            yield piece
