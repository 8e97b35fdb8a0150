"""Small files of known structure, whole and broken, on which queries and tests run."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType

from lectern.sources.structure import PNG


def _chunk(name: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))


def sample_file(kind: int, text: str) -> bytes:
    """A small file: 0 a PNG, 1 a JPEG, 2 a GIF, 3 a TIFF of three pages, 4 a TIFF of one; 5 to 11 have a fault, 12 is none of them."""
    seed = zlib.crc32(text.encode()) & 0xFF
    head = struct.pack(">IIBBBBB", 3, 2, 8, 0, 0, 0, 0)
    pixels = zlib.compress(bytes([0, seed, 1, 2, 0, 3, 4, 5]))
    png = PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", pixels) + _chunk(b"IEND", b"")
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 2, 3, 1) + b"\x01\x11\x00"
    scan = b"\xff\xda" + struct.pack(">H", 8) + b"\x01\x01\x00\x00\x3f\x00" + bytes([seed & 0x7F]) + b"\xff\x00\xff\xd0\x12"
    jpeg = b"\xff\xd8\xff\xe0\x00\x04xx" + frame + scan + b"\xff\xd9"
    gif = b"GIF89a" + struct.pack("<HHBBB", 3, 2, 0x80, 0, 0) + bytes([seed] * 6) + b"\x21\xf9\x04\x00\x00\x00\x00\x00" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 3, 2, 0) + b"\x02\x02\x4c\x01\x00\x3b"

    def tiff(pages: int) -> bytes:
        out = b"II*\0" + struct.pack("<I", 8)
        for k in range(pages):
            at = len(out)
            entries = [(256, 3, 1, 3), (257, 3, 1, 2), (273, 4, 1, 4), (279, 4, 1, 4)]
            out += struct.pack("<H", 4) + b"".join(struct.pack("<HHII", *e) for e in entries) + struct.pack("<I", at + 54 if k + 1 < pages else 0)
        return out

    faults = {
        5: png[:40] + bytes([png[40] ^ 1]) + png[41:],
        6: PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(b"\0\1\2\3")) + _chunk(b"IEND", b""),
        7: png[:-12],
        8: jpeg[:-2],
        9: gif[:-1],
        10: tiff(1).replace(struct.pack("<HHII", 279, 4, 1, 4), struct.pack("<HHII", 279, 4, 1, 4000)),
        11: b"\xff\xd8" + scan + b"\xff\xd9",
        12: b"plain " + text.encode()[:9],
    }
    return faults[kind] if kind in faults else (png, jpeg, gif, tiff(3), tiff(1))[kind]


@pandas_udf(BinaryType())
def file_of(kind: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([sample_file(int(k), t or "") for k, t in zip(kind, text, strict=True)])
