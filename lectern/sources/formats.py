"""Formats told by their first bytes, and rules for paths and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signatures in the order in which they are looked for.
SIGNATURES = (
    ("png", ("89504E470D0A1A0A",)),
    ("jpeg", ("FFD8",)),
    ("tiff", ("49492A00", "4D4D002A", "49492B00", "4D4D002B")),
    ("gif", ("474946383761", "474946383961")),
    ("bmp", ("424D", "4241", "4349", "4350", "4943", "5054")),
)
PDF_HEAD = 1024
#: Brands of ISO media files.
HEIC = ("heic", "heix", "heim", "heis", "hevc", "hevx", "hevm", "hevs")
AVIF = ("avif", "avis")
HEIF = ("mif1", "msf1")


def sniff(content: Column) -> Column:
    """The format that a binary's first bytes claim, or null."""
    begins = lambda signs: F.arrays_overlap(F.array(*[F.hex(F.substring(content, 1, len(s) // 2)) for s in signs]), F.array(*map(F.lit, signs)))
    head = F.hex(F.substring(content, 1, PDF_HEAD))
    named = F.when(F.regexp_like(head, F.lit("^(..)*?255044462D")), "pdf")
    for name, signs in SIGNATURES:
        named = named.when(begins(signs), name)
    word = lambda at: F.decode(F.substring(content, at, 4), "ISO-8859-1")
    named = named.when((word(1) == "RIFF") & (word(9) == "WEBP"), "webp")
    size = F.conv(F.hex(F.substring(content, 1, 4)), 16, 10).cast("long")
    end = F.least(F.greatest(size, F.lit(12)), F.octet_length(content), F.lit(4096)).cast("int")
    text = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    later = F.when(end > 16, F.transform(F.sequence(F.lit(16), end - 1, F.lit(4)), lambda at: F.substr(text, at + 1, F.lit(4)))).otherwise(F.array().cast("array<string>"))
    brands = F.concat(F.array(word(9)), later)
    media = (F.octet_length(content) >= 12) & (word(5) == "ftyp")
    for name, words in (("heic", HEIC), ("avif", AVIF), ("heif", HEIF)):
        named = named.when(media & F.arrays_overlap(brands, F.array(*map(F.lit, words))), name)
    return named


def safe_path(path: Column) -> Column:
    """Whether a relative path has no root, no backslash and no empty, '.' or '..' part."""
    return ~path.startswith("/") & ~F.contains(path, F.lit("\\")) & ~F.exists(F.split(path, "/"), lambda p: p.isin("", ".", ".."))


def approved_location(uri: Column, roots: list[str]) -> Column:
    out = F.lit(False)
    for r in roots:
        out = out | uri.startswith(r)
    return out
