"""Structure of image files told from their bytes alone: is a PNG, JPEG, GIF or TIFF whole, before anything decodes it.

`fault` names the first thing that is wrong, or nothing. What takes a decoder (pixels, colours) isn't looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType, StringType

#: Signatures, the samples a pixel by PNG colour type, the passes of interlaced PNG, bytes of TIFF types.
PNG = b"\x89PNG\r\n\x1a\n"
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
_TIFF_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
#: The most that the pixels of a PNG are inflated to.
MOST_PIXEL_BYTES = 1 << 30


class Broken(Exception):
    """What is wrong with a file."""


def _need(ok: bool, why: str) -> None:
    if not ok:
        raise Broken(why)


def _png_chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(PNG)
    while at < len(data):
        _need(at + 12 <= len(data), "chunk cut off")
        size, name = struct.unpack_from(">I4s", data, at)
        _need(at + 12 + size <= len(data), "chunk cut off")
        body = data[at + 8 : at + 8 + size]
        _need(zlib.crc32(name + body) == struct.unpack_from(">I", data, at + 8 + size)[0], "chunk checksum")
        yield name, body
        at += 12 + size
        if name == b"IEND":
            _need(at == len(data), "bytes after the end")


def _png_bytes(width: int, height: int, bits: int, interlaced: int) -> int:
    """Bytes of filtered scanlines; bits are those of a pixel."""
    if not interlaced:
        return height * (1 + (width * bits + 7) // 8)
    total = 0
    for x, y, dx, dy in _PASSES:
        w, h = (width - x + dx - 1) // dx, (height - y + dy - 1) // dy
        total += h * (1 + (w * bits + 7) // 8) if w > 0 else 0
    return total


def _png(data: bytes) -> None:
    _need(data.startswith(PNG), "signature")
    inflate, total, expected, names = zlib.decompressobj(), 0, 0, []
    for name, body in _png_chunks(data):
        if not names:
            _need(name == b"IHDR" and len(body) == 13, "no header first")
            width, height, depth, colour, packed, filters, interlaced = struct.unpack(">IIBBBBB", body)
            _need(width > 0 and height > 0, "no pixels")
            _need(colour in _SAMPLES and depth in (1, 2, 4, 8, 16) and packed == filters == 0 and interlaced in (0, 1), "header values")
            expected = _png_bytes(width, height, depth * _SAMPLES[colour], interlaced)
            _need(expected <= MOST_PIXEL_BYTES, "too many pixels")
        if name == b"IDAT":
            _need(b"IDAT" not in names or names[-1] == b"IDAT", "pixels in two places")
            try:
                while body and not inflate.eof:
                    total += len(inflate.decompress(body, 1 << 20))
                    body = inflate.unconsumed_tail
            except zlib.error as e:
                raise Broken("pixels don't inflate") from e
            _need(total <= expected, "more pixels than declared")
        names.append(name)
    _need(bool(names) and names[-1] == b"IEND", "no end")
    _need(inflate.eof and total == expected, "fewer pixels than declared")


def _jpeg(data: bytes) -> None:
    _need(data[:2] == b"\xff\xd8", "signature")
    at, frame, scan = 2, False, False
    while True:
        _need(at + 2 <= len(data), "no end")
        _need(data[at] == 0xFF, "no marker")
        while at < len(data) and data[at] == 0xFF:
            at += 1
        _need(at < len(data), "no end")
        mark, at = data[at], at + 1
        if mark == 0xD9:
            _need(frame and scan, "no picture")
            return
        if mark == 0x01 or 0xD0 <= mark <= 0xD7:
            continue
        _need(mark not in (0x00, 0xD8), "marker out of place")
        _need(at + 2 <= len(data), "segment cut off")
        size = struct.unpack_from(">H", data, at)[0]
        _need(size >= 2 and at + size <= len(data), "segment cut off")
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            _need(size >= 8, "frame too short")
            height, width, parts = struct.unpack_from(">HHB", data, at + 3)
            _need(width > 0 and parts > 0 and size == 8 + 3 * parts, "frame values")
            frame = True
        at += size
        if mark == 0xDA:
            _need(frame, "scan before its frame")
            scan = True
            while True:  # coded pixels: a marker ends them, stuffed bytes and restarts don't
                at = data.find(b"\xff", at)
                _need(0 <= at < len(data) - 1, "no end")
                if data[at + 1] == 0x00 or 0xD0 <= data[at + 1] <= 0xD7:
                    at += 2
                else:
                    break


def _gif(data: bytes) -> None:
    _need(data[:6] in (b"GIF87a", b"GIF89a"), "signature")
    _need(len(data) >= 13, "header cut off")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    _need(width > 0 and height > 0, "no pixels")
    at, pictures = 13 + (3 << (flags & 7) + 1 if flags & 0x80 else 0), 0

    def blocks(at: int) -> int:
        while True:
            _need(at < len(data), "block cut off")
            size = data[at]
            at += 1 + size
            _need(at <= len(data), "block cut off")
            if size == 0:
                return at

    while True:
        _need(at < len(data), "no end")
        kind, at = data[at], at + 1
        if kind == 0x3B:
            _need(pictures > 0, "no picture")
            return
        if kind == 0x21:
            at = blocks(at + 1)
        else:
            _need(kind == 0x2C, "unknown block")
            _need(at + 9 <= len(data), "block cut off")
            x, y, w, h, own = struct.unpack_from("<HHHHB", data, at)
            _need(w > 0 and h > 0 and x + w <= width and y + h <= height, "picture outside the screen")
            at += 9 + (3 << (own & 7) + 1 if own & 0x80 else 0)
            _need(at < len(data) and 2 <= data[at] <= 11, "code size")
            at, pictures = blocks(at + 1), pictures + 1


def _tiff(data: bytes) -> int:
    """The number of a TIFF's directories, which are its pages."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    _need(order is not None and len(data) >= 8, "signature")
    version = struct.unpack_from(order + "H", data, 2)[0]
    if version == 42:
        count, entry, offset, inline, at = "H", 12, "I", 4, struct.unpack_from(order + "I", data, 4)[0]
    else:
        _need(version == 43 and len(data) >= 16 and struct.unpack_from(order + "HH", data, 4) == (8, 0), "signature")
        count, entry, offset, inline, at = "Q", 20, "Q", 8, struct.unpack_from(order + "Q", data, 8)[0]
    wide, seen, pages = struct.calcsize(count), set(), 0
    while at:
        _need(at not in seen, "directories in a ring")
        seen.add(at)
        _need(at + wide <= len(data), "directory outside the file")
        n = struct.unpack_from(order + count, data, at)[0]
        end = at + wide + n * entry
        _need(n > 0 and end + inline <= len(data), "directory outside the file")
        tags = {}
        for k in range(n):
            tag, kind, number = struct.unpack_from(order + "HH" + offset, data, at + wide + k * entry)
            _need(kind in _TIFF_BYTES, "unknown type")
            size, place = number * _TIFF_BYTES[kind], at + wide + k * entry + 4 + inline
            if size > inline:
                place = struct.unpack_from(order + offset, data, place)[0]
                _need(place + size <= len(data), "values outside the file")
            if kind in (3, 4, 16) and number:
                code = {3: "H", 4: "I", 16: "Q"}[kind]
                tags[tag] = struct.unpack_from(f"{order}{min(number, 1 << 20)}{code}", data, place)
        _need(tags.get(256, (0,))[0] > 0 and tags.get(257, (0,))[0] > 0, "no pixels")
        parts = [(273, 279), (324, 325)]  # strips, tiles
        held = next(((tags[a], tags[b]) for a, b in parts if a in tags and b in tags), None)
        _need(held is not None and len(held[0]) == len(held[1]), "no strips or tiles")
        _need(all(a + b <= len(data) for a, b in zip(*held, strict=True)), "pixels outside the file")
        pages += 1
        at = struct.unpack_from(order + offset, data, end)[0]
    _need(pages > 0, "no directory")
    return pages


_CHECKS = {"png": _png, "jpeg": _jpeg, "gif": _gif, "tiff": _tiff}


def fault(kind: str | None, data: bytes | None) -> str | None:
    """What is wrong with a file of a kind; None if nothing, 'unknown format' if the kind isn't one of those checked."""
    if not data:
        return "empty"
    if kind not in _CHECKS:
        return "unknown format"
    try:
        _CHECKS[kind](data)
    except Broken as e:
        return str(e)
    except struct.error:
        return "cut off"
    return None


@pandas_udf(StringType())
def structural_fault(kind: pd.Series, data: pd.Series) -> pd.Series:
    return pd.Series([fault(k, None if d is None else bytes(d)) for k, d in zip(kind, data, strict=True)], dtype=object)


def page_count(kind: str | None, data: bytes | None) -> int:
    """Pages that a file holds: the directories of a TIFF, one for any other; a broken TIFF has one, which is refused later."""
    if kind != "tiff" or not data:
        return 1
    try:
        return _tiff(data)
    except (Broken, struct.error):
        return 1


@pandas_udf(IntegerType())
def pages_of(kind: pd.Series, data: pd.Series) -> pd.Series:
    return pd.Series([page_count(k, None if d is None else bytes(d)) for k, d in zip(kind, data, strict=True)])
