from __future__ import annotations

import numpy as np
import pytest
import xxhash

from stoptide.llm import common, simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints: dict[int, int]) -> dict[int, int]:
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprint():
    for text in (None, "", " \t\n", "One", "one TWO", "a b c", "a b c a b c d e f g", "é É ß x y z",
                 "a\x0bb\x0cc\x1cd e", "word " * 40000):
        assert simhash.fingerprint(text) == slow_print(text)


def met(prints):
    prints = np.array(prints, np.uint64)
    every = np.repeat(prints, simhash.CODES)
    codes = np.tile(np.arange(simhash.CODES, dtype=np.uint8), len(prints))
    return {tuple(sorted(p)) for p in zip(*(x.tolist() for x in simhash.meet(every, codes)))}


@pytest.mark.parametrize("distance", [1, 2, 3, 4, 5])
def test_balls_meet_exactly_within_three_bits(distance):
    rng = np.random.default_rng(distance)
    for _ in range(200):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(64, distance, replace=False):
            y ^= 1 << int(b)
        assert met([x, y]) == ({(min(x, y), max(x, y))} if distance <= 3 else set())


def test_three_bits_on_every_side():
    x = 0x0123456789ABCDEF
    for bits in ((0, 1, 2), (40, 50, 60), (0, 1, 63), (0, 62, 63), (15, 16, 31), (32, 47, 48)):
        y = x
        for b in bits:
            y ^= 1 << b
        assert len(met([x, y])) == 1 and len(met([y, x ^ (1 << 5)])) <= 1


def test_a_large_group_stays_a_star():
    """A thousand neighbours of one fingerprint: some links each, all in one component."""
    rng = np.random.default_rng(8)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre}
    while len(prints) < 1000:
        bits = rng.choice(64, 2, replace=False)
        prints.add(centre ^ (1 << int(bits[0])) ^ (1 << int(bits[1])))
    pairs = met(sorted(prints))
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    seen, todo = {centre}, [centre]
    near = {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    while todo:
        for b in near.get(todo.pop(), []):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    assert seen == prints


def test_documents(spark, docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base), (9, base.replace("w200", "other")), (1, None), (2, " "),
            (7, "short text"), (8, "SHORT  text"), (10, " ".join(f"v{i}" for i in range(300))),
            (10, " ".join(f"v{i}" for i in range(300))), (None, base), (None, "nothing alike x")]
    df = docs([(i, t, "en", "s") for i, t in rows], "component_id")
    found = simhash.near_duplicates(df).collect()
    prints = {i: slow_print(t) for i, t in rows if i is not None}
    want = slow_components(prints)
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert r["print"] % (1 << 64) == prints[r["doc_id"]]
            assert r["component_id"] == want[r["doc_id"]]
    nameless = sorted((r["component_id"] for r in found if r["doc_id"] is None), key=str)
    assert nameless == [3, None]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_links_of_random_fingerprints(spark):
    rng = np.random.default_rng(3)
    prints = []
    for c in rng.integers(0, 1 << 62, 40).tolist():
        for _ in range(8):
            c ^= 1 << int(rng.integers(0, 63))
            c ^= 1 << int(rng.integers(0, 63))
            prints.append(c)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p,) for p in prints], "print LONG")
    parts = {r["node"]: r["component"] for r in
             common.components(simhash.links(df, 4)).collect()}
    want = slow_components(dict(zip(prints, prints)))
    assert {i: parts.get(i, i) for i in want} == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] \
        + [(200, 200), (None, 3), (301, 300), (300, 301), (301, 300)]
    found = {r["node"]: r["component"] for r in common.components(
        spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert found == {i: 0 for i in range(61)} | {k: 100 for k in range(100, 140)} \
        | {300: 300, 301: 300}
    assert common.components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0
