from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
import pytest

from stoptide.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(text, items):
    table = defaultdict(set)
    for item, value in items:
        w = words(value)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            table[tuple(w[i:i + n])].add(item)
    w, hit, names = words(text), set(), set()
    for n in {len(k) for k in table}:
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in table:
                hit.update(range(i, i + n))
                names |= table[tuple(w[i:i + n])]
    return len(w), len(hit), sorted(x for x in names if x is not None)


LONG = " ".join(f"Item{i}" for i in range(30))
ITEMS = [("1", LONG), ("2", "Four little words here"), ("3", None), ("4", " -- "),
         ("5", LONG), (None, "nameless words"), ("6", " ".join(["same"] * 20)),
         ("7", "ÄÖ größe, naïve-é " * 5)]
TEXTS = [None, "", "no hit", LONG.upper().replace(" ", " ,- "), f"x {LONG} y " + "z " * 900,
         "four LITTLE words, here four little words here", " ".join(f"item{i}" for i in range(12)),
         "same " * 50, "nameless words", "äö größe naïve é äö größe naïve é äö größe naïve é x",
         "ÄÖ größe, naïve-é " * 5, "fourlittle words here", "four little words herE" * 3]


@pytest.mark.parametrize("limit", [1 << 20, 700])
def test_documents_against_brute_force(spark, docs, limit):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(None, None, None, None)]
    bench = spark.createDataFrame(ITEMS, "item_id STRING, text STRING")
    found = decontaminate.scan(docs(rows, "scan"), bench, block_bytes=limit).collect()
    assert len(found) == len(rows)
    for r in found:
        s = r["scan"]
        assert (s["n_words"], s["n_hit"], s["items"]) == slow(r["text"], ITEMS), r["text"]
        assert sum(b - a for a, b in s["spans"]) == s["n_hit"]


def test_repeated_items_are_dealt_out_once(spark):
    rows = [(str(i), f"item number {i} " + "word " * 8) for i in range(40)]
    bench = spark.createDataFrame(rows + [rows[0]] * 400 + [(None, "nameless")] * 50,
                                  "item_id STRING, text STRING")
    blocks = list(decontaminate.item_blocks(bench, "text", "item_id", 2048))
    assert sorted((x for b in blocks for x in b), key=str) == sorted(
        [*rows, (None, "nameless")], key=str)


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id STRING, text STRING")
    df = docs([(1, LONG, "en", "s")])
    assert decontaminate.scan(df.limit(0), bench).count() == 0
    (row,) = decontaminate.scan(df, bench.limit(0)).collect()
    assert (row["scan"]["n_words"], row["scan"]["n_hit"]) == (30, 0)


def test_texts_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(decontaminate, "_LONG", 64)
    text = f"a b c {LONG} d {LONG} four little words here " + "same " * 30
    table = decontaminate.Windows(ITEMS)
    (n, ranges, items), = decontaminate.scan_texts(pa.array([text]), table, 13)
    hit = sum(b - a for a, b in decontaminate._merged(ranges))
    assert (n, hit, sorted(items)) == slow(text, ITEMS)


def test_long_items_are_cut_with_overlap(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    bench = spark.createDataFrame([("1", text)], "item_id STRING, text STRING")
    blocks = list(decontaminate.item_blocks(bench, "text", "item_id", 8192))
    held = set()
    for items in blocks:
        held |= set(decontaminate.Windows(items).items)
    assert held == set(decontaminate.Windows([("1", text)]).items)
    assert len(blocks) > 1


def test_cut_out_spans(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id STRING, text STRING")
    df = docs([(1, f"keep this. {LONG}, and this.", "en", "s"), (2, None, "en", "s")])
    out = decontaminate.without_spans(decontaminate.scan(df, bench)).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["keep this. , and this.", None]


def test_rule_of_a_twentieth(spark, docs):
    bench = spark.createDataFrame([("2", "Four little words here")], "item_id STRING, text STRING")
    rows = [(n, "four little words here " + "x " * n, "en", "s") for n in (75, 76, 77)]
    out = decontaminate.scan(docs(rows), bench)
    out = out.select("doc_id", decontaminate.contaminated(out["scan"]).alias("c")).collect()
    assert {r["doc_id"]: r["c"] for r in out} == {75: True, 76: True, 77: False}


def test_long_items_are_cut_for_other_windows(spark, docs):
    text = " ".join(f"w{i}" for i in range(600))
    bench = spark.createDataFrame([("1", text)], "item_id STRING, text STRING")
    words = text.split()
    rows = [(i, " ".join(words[i:i + 20]), "en", "s") for i in range(581)]
    out = decontaminate.scan(docs(rows), bench, window=20, block_bytes=4096)
    assert {r["scan"]["n_hit"] for r in out.select("scan").collect()} == {20}
