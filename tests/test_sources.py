from __future__ import annotations

import hashlib
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from lectern.functions import display as D
from lectern.operators import contracts as K
from lectern.sources import formats, policies, samples, sinks, structure


def test_inventory(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_bytes(b"one")
    (tmp_path / "y.bin").write_bytes(b"two")
    (tmp_path / "none").write_bytes(b"")
    folder = f"file://{tmp_path}"
    got = {r["relative_path"]: (r["bytes"], r["sha256"]) for r in sinks.inventory(spark, folder, 10).collect()}
    assert got == {"a/x.txt": (3, hashlib.sha256(b"one").hexdigest()), "y.bin": (3, hashlib.sha256(b"two").hexdigest()), "none": (0, hashlib.sha256(b"").hexdigest())}
    for why, bounds in (("larger than 2", (2,)), ("more than 2", (10, 2)), ("deeper than 0", (10, 9, 0))):
        with pytest.raises(sinks.Refused, match=why):
            sinks.inventory(spark, folder, *bounds)
    os.mkfifo(tmp_path / "pipe")
    with pytest.raises(sinks.Refused, match="no regular file: pipe"):
        sinks.inventory(spark, folder, 10)
    (tmp_path / "pipe").unlink()
    listed = sinks.inventory(spark, folder, 10)
    (tmp_path / "y.bin").write_bytes(b"more than two")
    with pytest.raises(Exception, match="changed while it was read"):
        listed.collect()
    (tmp_path / "link").symlink_to(tmp_path / "none")
    with pytest.raises(sinks.Refused, match="a link: link"):
        sinks.inventory(spark, folder, 100)


def test_structure_of_files():
    good = {k: samples.sample_file(k, "text") for k in range(5)}
    kinds = ("png", "jpeg", "gif", "tiff", "tiff")
    for k, data in good.items():
        assert structure.fault(kinds[k], data) is None
        # whatever is cut off or turned is told or harmless, and never raises
        for cut in range(len(data)):
            assert structure.fault(kinds[k], data[:cut]) is not None, (k, cut)
            structure.fault(kinds[k], data[:cut] + bytes([data[cut] ^ 0xFF]) + data[cut + 1 :])
        assert structure.fault(kinds[(k + 1) % 4], data) is not None
    assert all(structure.fault("png", good[0][:at] + bytes([good[0][at] ^ 1]) + good[0][at + 1 :]) for at in range(len(good[0])))
    assert [structure.page_count("tiff", good[k]) for k in (3, 4)] == [3, 1] and structure.page_count("png", good[0]) == 1
    ring = bytearray(good[3])
    ring[58:62] = struct.pack("<I", 8)
    assert structure.fault("tiff", bytes(ring)) == "directories in a ring"
    assert structure.fault("png", b"") == "empty" and structure.fault(None, b"x") == "unknown format"
    head = struct.pack(">IIBBBBB", 3, 5, 1, 0, 0, 0, 1)
    size = structure._png_bytes(3, 5, 1, 1)
    png = structure.PNG + samples._chunk(b"IHDR", head) + samples._chunk(b"IDAT", zlib.compress(bytes(size))) + samples._chunk(b"IEND", b"")
    assert structure.fault("png", png) is None and size == sum(h * (1 + (w + 7) // 8) for w, h in ((1, 1), (1, 1), (1, 2), (2, 1), (1, 3), (3, 2)))


def test_sections_read_back(spark):
    rows = spark.createDataFrame([("a", "x\n=== b 1\ny"), ("b", ""), ("c", "é\n")], "k string, t string")
    assert sorted(map(tuple, sinks.scan_sections(sinks.sections(rows, "k", "t")).collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(Exception, match="cut off"):
        sinks.scan_sections(spark.createDataFrame([("=== a 5\nxx",)], "section string")).collect()


def test_policies_are_closed(spark, tmp_path):
    good = tmp_path / "a.toml"
    good.write_text("max_characters = 5\nmax_character_pairs = 6\ntimeout_seconds = 7\n")
    values, seal = policies.load(str(good), policies.ALIGNMENT)
    assert values["max_characters"] == 5 and seal == hashlib.sha256(good.read_bytes()).hexdigest()
    assert policies.as_rows(spark, values).count() == 3
    for bad in ("max_characters = 5\n", "max_characters = true\nmax_character_pairs = 6\ntimeout_seconds = 7\n", "max_characters = 5\nmax_character_pairs = 6\ntimeout_seconds = 7\nmore = 1\n"):
        good.write_text(bad)
        with pytest.raises(ValueError):
            policies.load(str(good), policies.ALIGNMENT)


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, "x\ny"), ("a", 1, 'q"\\'), ("a", 3, "é")], "folder string, o int, t string")
    lines = sinks.json_lines(rows, F.struct("folder", "o", "t"), "o")
    lines.write.text(str(tmp_path / "lines"))
    back = sinks.scan_json_lines(spark.read.text(str(tmp_path / "lines")).withColumnRenamed("value", "line"), "folder string, o int, t string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    sinks.write_bundles(rows.filter("o <> 2"), "folder", "o", "t", str(tmp_path / "bundle"))
    assert spark.read.text(str(tmp_path / "bundle")).count() == 2
    index = sinks.overwrite_index(sinks.overwrite_index(rows, str(tmp_path / "i")).limit(0), str(tmp_path / "j"))
    assert index.count() == 0
    sinks.publish_tree(rows, ["folder"], str(tmp_path / "tree"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.publish_tree(rows, ["folder"], str(tmp_path / "tree"))
    numbered = sinks.numbered_in_order(rows, "o", "n")
    assert sorted((r["o"], r["n"]) for r in numbered.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_formats(spark):
    cases = [(b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8", "jpeg"), (b"MM\x00+x", "tiff"), (b"GIF89a", "gif"), (b"BM", "bmp"), (b"x" * 1019 + b"%PDF-", "pdf"), (b"x" * 1020 + b"%PDF-", None), (b"RIFF1234WEBP", "webp"), (b"", None),
             (b"\0\0\0\x18ftypheic", "heic"), (b"\0\0\0\x18ftypisom0000mif1avif", "avif"), (b"\0\0\0\x10ftypisom0000mif1", None), (b"\0\0\0\x18ftypmif1", "heif"), (b"ftypheic", None)]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, (b, _) in enumerate(cases)], "i int, b binary")
    assert [r["f"] for r in rows.select("i", formats.sniff(F.col("b")).alias("f")).orderBy("i").collect()] == [w for _, w in cases]


def test_strict_contracts_refuse(spark):
    rows = spark.createDataFrame([(1, True), (2, None)], "k int, ok boolean")
    assert list(map(tuple, K.violations(rows, ["k"], {"ok": F.col("ok")}).collect())) == [(2, "ok")]
    assert K.required(rows.limit(1), ["k"], {"ok": F.col("ok")}).count() == 1
    with pytest.raises(Exception, match="ok: 2"):
        K.required(rows, ["k"], {"ok": F.col("ok")}).collect()


def test_display():
    for text in ("", "plain", "⟦a⟧\\⟨b⟩", "é" * 20):
        spans = [(0, 1), (2, 4)] if len(text) >= 4 else []
        assert D.strip(D.render(text, spans, [(0, "torn"), (len(text), "faded")])) == text
    assert D.render("abc", [(1, 2)], [(1, "torn")]) == "a⟨torn⟩⟦b⟧c"
    assert D.attribute_change("abcdef", "abXdef", [(0, 6, "order"), (2, 3, "numbering"), (1, 3, "date-sequence")]) == "numbering"
    assert D.attribute_change("a", "a", []) is None and D.attribute_change("ab", "xb", [(1, 2, "order")]) == "outside every flag"
    with pytest.raises(ValueError):
        D.reconcile_drafts("ab", "ac", {})
