"""Unpacked sizes of archives from their last bytes alone, read from anything that can seek."""

from __future__ import annotations

import struct
from typing import BinaryIO

#: Fixed values of the zip format: marks of the end record, of the 64-bit end record and its locator, and of a directory entry; the extra field with 64-bit sizes.
END, END64, LOCATOR, ENTRY, WIDE = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", 1
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
#: Bytes of a directory that are held at a time.
PIECE = 1 << 20


def tail_of(f: BinaryIO, size: int, n: int) -> bytes:
    f.seek(max(0, size - n))
    return f.read(min(n, size))


def gzip_size(f: BinaryIO, size: int) -> int:
    """The last four bytes: the size modulo 4 GiB, so that a file of 4 GiB or more packed into more bytes than that says is told apart by the caller."""
    tail = tail_of(f, size, 4)
    f.seek(0)
    if size < 18 or f.read(2) != b"\x1f\x8b":
        raise ValueError("no gzip file")
    return struct.unpack("<I", tail)[0]


def directory(f: BinaryIO, size: int) -> tuple[int, int, int]:
    """Where a zip file's directory starts, its bytes and its number of entries; bytes before the archive (a self-extracting file) shift it."""
    tail = tail_of(f, size, 22 + FULL16)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = size - len(tail) + at
    if entries == FULL16 or length == FULL32 or start == FULL32:
        f.seek(max(0, end - 20))
        locator = f.read(20)
        if end >= 20 and locator[:4] == LOCATOR:
            f.seek(struct.unpack_from("<Q", locator, 8)[0])
            record = f.read(56)
            if len(record) < 56 or record[:4] != END64:
                raise ValueError("no 64-bit end record")
            entries, length, start = struct.unpack_from("<QQQ", record, 32)
            return start, length, entries
    if length > end:
        raise ValueError("the directory is cut")
    return end - length, length, entries


def zip_size(f: BinaryIO, size: int) -> int:
    """The sum of the directory's sizes; a 64-bit size stands in the extra field where the entry's own is full. The directory is read in pieces."""
    start, length, entries = directory(f, size)
    f.seek(start)
    left, held, total, seen = length, b"", 0, 0
    at = 0

    def room(n: int) -> None:
        nonlocal held, at, left
        while len(held) - at < n:
            more = f.read(min(PIECE, left))
            if not more:
                raise ValueError("the directory is cut")
            held, at, left = held[at:] + more, 0, left - len(more)

    while seen < entries:
        room(46)
        if held[at : at + 4] != ENTRY:
            raise ValueError(f"entry {seen} is malformed")
        unpacked, name, extra, comment = struct.unpack_from("<I", held, at + 24)[0], *struct.unpack_from("<HHH", held, at + 28)
        room(46 + name + extra + comment)
        if unpacked == FULL32:
            unpacked = wide_size(held[at + 46 + name : at + 46 + name + extra])
        total += unpacked
        at, seen = at + 46 + name + extra + comment, seen + 1
    return total


def wide_size(extra: bytes) -> int:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == WIDE and n >= 8:
            return struct.unpack_from("<Q", extra, at + 4)[0]
        at += 4 + n
    raise ValueError("a 64-bit size is missing")


def unpacked_size(f: BinaryIO, name: str, size: int) -> tuple[str, int, str | None]:
    """kind, size, reason. By the name's end: gzip and zip files; others have no archive's kind and their own size. What can't be read counts as 0, with the reason."""
    kind = "gzip" if name.lower().endswith(".gz") else "zip" if name.lower().endswith(".zip") else "archive" if name.lower().endswith((".rar", ".7z")) else "file"
    if kind == "file":
        return kind, size, None
    try:
        if kind == "archive":
            raise ValueError("no reader for this kind")
        unpacked = (gzip_size if kind == "gzip" else zip_size)(f, size)
        # deflate packs at most 1032 to 1, and its blocks cost 5 bytes in 65535: a remainder that the file can't be has lost a multiple of 4 GiB
        wrapped = kind == "gzip" and unpacked < size - 18 - 5 * (size // 65535 + 1) - 65_536
        return kind, unpacked, "over 4 GiB: the size is a remainder" if wrapped else None
    except (ValueError, struct.error) as e:
        return kind, 0, str(e)
