from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from stoptide.llm import prefixes

KIND = "conv_id LONG, turn LONG, role STRING, text STRING, depth STRING, a STRING"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append(((t is not None, t or 0), r or "", x or ""))
    for c in by:
        by[c].sort()
    out = {}
    for c in list(by):
        h = zlib.crc32(str(c).encode()) % 6
        head = by.get(c - int(math.fmod(c, 100)), [])[:h]
        out[c] = tuple((r, x) for _, r, x in head + by[c][h:])
    return out


def slow(rows):
    whole = rebuilt(rows)
    members, kids = defaultdict(list), defaultdict(set)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                kids[s[:d - 1]].add(s[:d])
    out = {}
    for s in sorted(members, key=len, reverse=True):
        m, below = members[s], kids.get(s, ())
        saved = (len(m) - 1) * (len(s[-1][1]) if s else 0) + sum(out[x][6] for x in below)
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(s))))
        out[s] = (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(below),
                  sum(out[x][5] for x in below) if below else 1, saved,
                  hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def nodes(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], KIND)
    found = prefixes.trie(prefixes.rebuild(prefixes.ordered(df)))
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


def conversations(seed, n=160, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 450), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t * 2, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "çé😀"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = conversations(seed)
    assert nodes(spark, rows) == slow(rows)


def test_long_and_hot_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BLOCK", 16)
    monkeypatch.setattr(prefixes, "CHUNK_BYTES", 40)
    monkeypatch.setattr(prefixes.running, "__defaults__", (16,))
    rows = [(7, t, "user", f"turn {t % 3}") for t in range(900)]
    rows += [(8, t, "user", f"turn {t % 3}") for t in range(450)]     # a prefix of the other
    for c in range(1000, 1300):                                       # copies
        rows += [(c, t, "u", "same") for t in range(8)]
    random.Random(3).shuffle(rows)
    assert nodes(spark, rows) == slow(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, "b", "x"), (1, 3, "a", ""), (1, 3, "a", ""),
            (None, 1, "a", "lost"), (205, 1, "u", "only"), (200, 5, "u", "head"),
            (200, 4, None, "first"), (203, 1, "u", "own"), (203, 1, "u", "own"),
            (-1, 0, "r" * 70 + "b", "t"), (-1, 0, "r" * 70 + "a", "z"), (-1, 0, "r", "x" * 80 + "b"),
            (-1, 0, "r", "x" * 80 + "a"), (-1, 0, "r" * 64, "q"), (-1, -2, "a:", "b"),
            (50, 1, "1", "2"), (51, 1, "12", "")]
    assert nodes(spark, rows) == slow(rows)
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "a", "b")]) == []
    assert nodes(spark, [(5, 1, "a", "b")]) == slow([(5, 1, "a", "b")])


def test_places_over_many_ranges(spark):
    rows = [(1, t, "u", "") for t in range(3000)] + [(c, 0, "u", "") for c in range(2, 40)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], KIND)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = prefixes.ordered(df).where("conv_id = 1").select("place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["place"] for r in found) == list(range(1, 3001))


def test_texts(spark):
    rows = conversations(5, n=40)
    df = spark.createDataFrame([(*r, "", "") for r in rows], KIND)
    turns = prefixes.rebuild(prefixes.ordered(df))
    whole = rebuilt(rows)
    for r in prefixes.texts(prefixes.trie(turns), turns).collect():
        last = whole[r["conv_id"]][r["depth"] - 1] if r["depth"] else (None, None)
        assert (r["role"], r["text"]) == last
