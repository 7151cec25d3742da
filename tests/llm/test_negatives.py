from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stoptide.llm import negatives

KIND = "vec_id LONG, label INT, embedding ARRAY<DOUBLE>, rank STRING"


def slow(rows, width=6):
    rows = [(i, k, [int(np.floor(256 * x)) for x in v]) for i, k, v in rows
            if None not in (i, k, v) and len(v) == width
            and all(x is not None and np.isfinite(x) for x in v)]
    best = {}
    for i, k, v in rows:
        best[i] = min(best.get(i, (k, v)), (k, v))
    out = []
    for a, (label, v) in best.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=True)) for i, (_, w) in best.items()}
        order = sorted(best, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and best[i][0] == label][:5]:
            fit = [i for i in order if best[i][0] != label
                   and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fit[:3])]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], KIND)
    found = negatives.mine(df, **kw)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                             "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(n, seed, hot=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, 6))
    owner = rng.integers(0, 8, n)
    v = centres[owner] + rng.normal(scale=0.3, size=(n, 6))
    rows = [(i, int((owner[i] + (rng.random() < 0.3)) % 8), v[i].round(3).tolist())
            for i in range(n)]
    for i in range(hot):                                    # copies, ties, near copies
        rows.append((n + i, 1, v[0].round(3).tolist()))
        rows.append((n + hot + i, 2, (v[0] * 0.8).round(1).tolist()))
    return rows


@pytest.mark.parametrize("seeds", [1, 40, 10_000])
def test_against_brute_force(spark, monkeypatch, seeds):
    monkeypatch.setattr(negatives, "CELL_ROWS", 8)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "PACK", 3)
    rows = clustered(600, 3, hot=120)
    assert mined(spark, rows, seeds=seeds) == slow(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(120, 9)
    rows += [(None, 1, rows[0][2]), (700, None, rows[0][2]), (750, 1, None), (800, 1, []),
             (850, 1, [nan] * 6), (900, 1, [inf] + [0.0] * 5), (950, 1, [None] * 6),
             (1000, 1, [1.0, 2.0]), rows[50], rows[50], (50, 0, rows[3][2]),
             (1050, 3, [0.0] * 6), (1100, 3, [-0.0] * 6)]
    assert mined(spark, rows) == slow(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(50, 1, [1.0])]) == []
    assert mined(spark, [(50, None, [1.0])]) == []


def test_large_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, (rng.normal(size=6) * 3e6).tolist()) for i in range(60)]
    assert mined(spark, rows) == slow(rows)


def test_label_expression(spark):
    rows = clustered(200, 4)
    shifted = [(i, (k + 1) % 10 if i % 7 == 0 else k, v) for i, k, v in rows]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert mined(spark, rows, label=label) == slow(shifted)


def test_visits_are_in_order_and_bounds_hold():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(500, 6)) * 256)
    index = negatives.Index([negatives.codebook(v[:, :3], 7), negatives.codebook(v[:, 3:], 7)])
    words = []
    for k, half in enumerate((v[:, :3], v[:, 3:])):
        word, far = negatives.nearest(half, index.books[k])
        words.append(word)
        index.radii.append(np.array([far[word == j].max() if (word == j).any() else 0
                                     for j in range(len(index.books[k]))]))
    cells = list(zip(*[w.tolist() for w in words], strict=True))
    index.rows = {c: cells.count(c) for c in cells}
    found = list(index.visits(v[0]))
    bounds = [b for b, _, _ in found]
    assert bounds == sorted(bounds, reverse=True)
    assert sorted(c for _, *c in found) == sorted(map(list, index.rows))
    by_cell = {(a, b): bound for bound, a, b in found}
    assert all(by_cell[c] >= x @ v[0] for c, x in zip(cells, v, strict=True))


def test_products_are_exact():
    big = np.array([[2.0 ** 40, 3.0], [-(2.0 ** 40), 1.0]])
    want = [[(1 << 80) + 9, -(1 << 80) + 3], [-(1 << 80) + 3, (1 << 80) + 1]]
    clip = [[max(-2 ** 63, min(x, 2 ** 63 - 1)) for x in r] for r in want]
    assert negatives.products(big, big).tolist() == clip
