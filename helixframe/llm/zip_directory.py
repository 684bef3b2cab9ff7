"""Reading a ZIP archive's directory and stored members by ranges, ZIP64 included."""

from __future__ import annotations

import struct
from typing import NamedTuple

_END, _END64, _LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_ENTRY, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_TAIL = 22 + 65535


class Member(NamedTuple):
    name: str
    method: int
    size: int
    start: int  # of the member's bytes in the archive


def members(read, size: int) -> list[Member]:
    """The archive's members; ``read(offset, length)`` gives bytes of it, ``size`` is its length.

    Only the end of the archive, its central directory and the members' local headers are read.
    """
    tail_at = max(0, size - _TAIL)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or 0xFFFFFFFF in (length, offset):
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = read(offset, length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, header = _large(extra, plain, packed, header)
        local = read(header, 30)
        if local[:4] != _LOCAL:
            raise ValueError("damaged local header")
        skip = 30 + sum(struct.unpack_from("<HH", local, 26))
        found.append(Member(name, method, packed, header + skip))
        at += 46 + n_name + n_extra + n_comment
    return found


def _large(extra: bytes, *values: int) -> list[int]:
    """Values of 32 bits that are full are in the ZIP64 extra field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if v == 0xFFFFFFFF else v for v in values]
        at += 4 + length
    return list(values)
