from __future__ import annotations

import os
import struct

import pytest
import zstandard

from stoptide.llm import warc

KIND = "page_id LONG, url STRING, html STRING, payload STRING"
ROWS = [(3, "http://a/ü x", "<p>same</p>", "c"), (1, "http://b/", "<p>same</p>", "c"),
        (2, None, "<p>other é</p>", "c"), (5, "http://c\n/", None, "c"), (4, "u", "", "c"),
        (6, "u", "x" * 200_000, "c"), (6, "u", "x" * 200_000, "c"), (None, "u", "<p>same</p>", "c"),
        (None, "u", "nameless", "c"), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n", "c")]


def slow(rows):
    payloads = [(r[0], (r[2] or "").encode()) for r in rows]
    first = {}
    for page, p in payloads:
        if page is not None:
            first[p] = min(page, first.get(p, page))
    out = []
    for page, p in payloads:
        revisit = first.get(p, page) != page
        out.append((page, len(p), warc.digest(p), "revisit" if revisit else "response",
                    first[p] if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    found = warc.round_trip(spark.createDataFrame(ROWS, KIND)).collect()
    assert sorted([tuple(r) for r in found], key=str) == slow(ROWS)
    assert warc.round_trip(spark.createDataFrame([], KIND)).count() == 0


def test_many_archives_and_their_dictionary(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h/{i}", f"<html><body><p>page number {i} of a site with the same words "
             f"again and again {i * 7919 % 1000}</p></body></html>", "") for i in range(400)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    df = spark.createDataFrame(rows, KIND)
    assert warc.write(df, str(tmp_path / "w")) == 400
    files = sorted(f for f in os.listdir(tmp_path / "w") if f.endswith(".zst"))
    assert files and not [f for f in os.listdir(tmp_path / "w") if f.startswith("_")]
    data = (tmp_path / "w" / files[0]).read_bytes()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_MAGIC and size > 0
    records = warc.read(spark, str(tmp_path / "w")).collect()
    assert {r["payload"].decode() for r in records} == {r[2] for r in rows}
    assert not [r for r in records if r["error"]]


def _archive(*records, words=b"", packed=False):
    used = zstandard.ZstdCompressionDict(words) if words else None
    held = zstandard.ZstdCompressor().compress(words) if packed else words
    head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(held)) + held if words else b""
    return head + b"".join(zstandard.ZstdCompressor(dict_data=used).compress(r) for r in records)


@pytest.mark.parametrize("packed", [False, True])
def test_frames(packed):
    words = b"some words that the records have " * 20
    data = _archive(b"one", b"two" * 100_000, b"", words=words, packed=packed)
    assert list(warc.frames(data)) == [b"one", b"two" * 100_000, b""]
    inner = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    assert list(warc.frames(_archive(b"x") + inner + _archive(b"y"))) == [b"x", b"y"]
    for broken in (data[:-3], data + b"junk after it", data[:5],
                   struct.pack("<II", 0x184D2A50, 90)):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(broken))


GOOD = warc.record(1, "http://a/", b"<p>text</p>", None, False)


@pytest.mark.parametrize("change, says", [
    (lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1", 1), "no record header"),
    (lambda r: r.replace(b"WARC-Date", b"WARC-Day", 1), "missing warc-date"),
    (lambda r: r[:-4] + b"x\r\n\r\n", "Content-Length"),
    (lambda r: r.replace(b"<p>text", b"<p>tex!"), "block digest"),
    (lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "), "bad header"),
    (lambda r: r[:-2], "Content-Length"),
])
def test_broken_records(change, says):
    assert warc.parse(GOOD)["payload"] == b"<p>text</p>"
    with pytest.raises(ValueError, match=says):
        warc.parse(change(GOOD))


def test_reader_keeps_what_is_sound(spark, tmp_path):
    data = _archive(GOOD, GOOD.replace(b"<p>text", b"<p>tex!"), GOOD)
    (tmp_path / "a.warc.zst").write_bytes(data[:-2])
    rows = warc.read(spark, str(tmp_path)).collect()
    assert [r["error"] is None for r in rows] == [True, False, False]


def test_revisit_without_its_response(spark, tmp_path):
    lone = warc.record(2, "u", b"text", 1, True)
    (tmp_path / "a.warc.zst").write_bytes(_archive(lone))
    (row,) = warc.resolved(warc.read(spark, str(tmp_path))).collect()
    assert "missing" in row["error"]
