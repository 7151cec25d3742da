"""Hard negatives through an inverted multi-index.

A vector's components become whole numbers, and its two halves are assigned to the nearest words
of two codebooks; the pair of words is its cell. A row's score with an anchor is at most the sum
of two half bounds: the half's product with the word, plus its length times the word's radius
(the farthest row assigned to it). A heap visits the cells of an anchor by the sum of the bounds,
highest first, in the manner of the multi-sequence algorithm, and stops where no cell that is
left can change what was asked for: the first positives, or the first rows of every window of
negatives. So the result is exact, whatever the codebooks are; they only decide how many cells
are visited.

Rows lie in blocks of a cell; visits travel to the blocks in packs of anchors; a tile of a pack
and a block is one product of matrices. Only the best rows of an anchor leave a tile.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SCALE = 256
EVERY = 50                  # anchors are the rows whose id is divisible by this
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95          # a negative's score, in per cent of the positive's
CELL_ROWS = 512             # rows of a cell that the number of words aims at
MOST_WORDS = 512            # words of a codebook: the directory has at most its square of cells
SAMPLE = 16_384             # rows that the codebooks are fitted on
BLOCK = 1024                # rows of a block
PACK = 256                  # anchors that meet a block at once
SEED_ROWS = 4096            # rows that an anchor sees before its bounds are set
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


def whole_numbers(values: pa.Array) -> pa.Array:
    """floor(SCALE * x) of each vector, as bytes of doubles; null if it takes no part."""
    out = []
    for scalar in values:
        row = scalar.values if scalar.is_valid else None
        found = None
        if row is not None and len(row) and not row.null_count:
            v = row.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(v).all():
                with np.errstate(over="ignore"):
                    v = np.clip(np.floor(SCALE * v), -1e300, 1e300)
                found = (v + 0.0).tobytes()                 # no negative zero
        out.append(found)
    return pa.array(out, pa.binary())


def matrix(values: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond 64 bits, the nearest that fits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max(0) @ np.abs(b).max(0) < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    found = whole(a).dot(whole(b).T)
    return np.clip(found, -_LONG - 1, _LONG).astype(np.int64)


def codebook(half: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """Words of a half space by Lloyd's method, from evenly spaced rows of the sample."""
    different = np.unique(half, axis=0)
    points = different[np.linspace(0, len(different) - 1, min(words, len(different))).astype(int)]
    for _ in range(rounds):
        owner = nearest(half, points)[0]
        sums = np.zeros_like(points)
        np.add.at(sums, owner, half)
        count = np.bincount(owner, minlength=len(points))
        points = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], points)
    return points


def nearest(half: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, distance to it) of each row."""
    word = np.empty(len(half), np.int32)
    far = np.empty(len(half))
    squares = (points ** 2).sum(1)
    for k in range(0, len(half), 4096):
        part = half[k:k + 4096]
        word[k:k + 4096] = (squares - 2 * part @ points.T).argmin(1)
        far[k:k + 4096] = np.sqrt(((part - points[word[k:k + 4096]]) ** 2).sum(1))
    return word, far


class Index:
    """Codebooks, radii, and the number of blocks and rows of every cell that has any."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.radii: list[np.ndarray] = []
        self.rows: dict[tuple[int, int], int] = {}

    def bounds(self, vector: np.ndarray) -> list[np.ndarray]:
        """The greatest product of each half with a row of each word; a little more, as it is
        computed in floating point."""
        out, at = [], 0
        for points, radii in zip(self.books, self.radii, strict=True):
            half = vector[at:at + points.shape[1]]
            at += points.shape[1]
            length = np.sqrt(half @ half)
            slack = 1e-9 * length * (np.sqrt((points ** 2).sum(1)) + radii) + 1e-6
            out.append(points @ half + length * radii + slack)
        return out

    def visits(self, vector: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, word, word) of the cells that have rows, highest bound first.

        The multi-sequence walk: a cell is offered to the heap once its neighbours with the
        next higher bound in either half have been visited.
        """
        first, second = self.bounds(vector)
        left, right = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        a, b = first[left], second[right]
        heap, reached = [(-(a[0] + b[0]), 0, 0)], np.zeros(len(a) + 1, np.int64)
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(left[i]), int(right[j])
            if cell in self.rows:
                yield -bound, *cell
            reached[i] = j + 1
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
            if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


def build(rows: DataFrame, width: int, sample: int = SAMPLE) -> tuple[Index, DataFrame]:
    """The index of `rows` (vec_id, label, v), and its blocks (left, right, block, ids, labels,
    vectors), stored. Codebooks are fitted on a sample chosen by a hash; every row is entered."""
    spark = rows.sparkSession
    total = rows.count()
    words = int(min(MOST_WORDS, max(1, np.ceil(np.sqrt(total / CELL_ROWS)))))
    some = matrix([bytes(r["v"]) for r in common.hashed_sample(rows.select("v"), "v", sample)],
                  width)
    half = width // 2
    with np.errstate(over="ignore", invalid="ignore"):
        books = [codebook(_tame(some[:, :half]), words), codebook(_tame(some[:, half:]), words)]
    index = Index(books)

    def assign(batches):
        for batch in batches:
            v = _tame(matrix(batch.column("v").to_pylist(), width))
            (left, far_left), (right, far_right) = (
                nearest(v[:, :half], books[0]), nearest(v[:, half:], books[1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(left), pa.array(right), pa.array(far_left),
                 pa.array(far_right)],
                [*batch.schema.names, "left", "right", "far_left", "far_right"])

    entered = common.store(rows.mapInArrow(
        assign, "vec_id long, label long, v binary, left int, right int, "
                "far_left double, far_right double"), "entered")
    for k, side in enumerate(("left", "right")):
        radii = np.zeros(len(books[k]))
        for r in entered.groupBy(side).agg(F.max(f"far_{side}").alias("far")).collect():
            radii[r[side]] = r["far"]
        index.radii.append(radii)
    counts = entered.groupBy("left", "right").agg(F.count("*").alias("n")).collect()
    index.rows = {(r["left"], r["right"]): r["n"] for r in counts}
    shared = spark.sparkContext.broadcast(index)

    def pack(key, table):
        left, right, block = key
        return pa.table({
            "left": [left.as_py()], "right": [right.as_py()], "block": [block.as_py()],
            "ids": [table.column("vec_id").to_pylist()],
            "labels": [table.column("label").to_pylist()],
            "vectors": [b"".join(table.column("v").to_pylist())]}, schema=_BLOCK)

    def place(batches):
        for batch in batches:
            cells = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(),
                        batch.column("hash").to_pylist(), strict=True)
            blocks = [h % -(-shared.value.rows[a, b] // BLOCK) for a, b, h in cells]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(blocks, pa.int32())],
                [*batch.schema.names[:5], "block"])

    kind = "vec_id long, label long, v binary, left int, right int"
    hashed = entered.select("vec_id", "label", "v", "left", "right",
                            F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)).alias("hash"))
    blocks = hashed.mapInArrow(place, f"{kind}, block int").groupBy(
        "left", "right", "block").applyInArrow(
        pack, "left int, right int, block int, ids array<long>, labels array<long>, "
              "vectors binary")
    return index, common.store(blocks, "blocks")


_BLOCK = pa.schema([("left", pa.int32()), ("right", pa.int32()), ("block", pa.int32()),
                    ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())),
                    ("vectors", pa.binary())])


def _tame(v: np.ndarray) -> np.ndarray:
    """Components of a size that squares can be summed of; the same for the usual ones.

    Where it changes any, distances are no longer those of the rows, and radii say so.
    """
    return np.clip(v, -1e150, 1e150)


def search(queries: DataFrame, index: Index, blocks: DataFrame, width: int, most: int,
           seeds: int) -> DataFrame:
    """(query, asked, score, vec_id): the first `most` rows of every query's questions.

    A query is (query, label, v, asked): `asked` lists structs (low, high, same), each asking for
    the rows with a score from low to high that have its label (same) or another one. Two steps:
    every query sees the `seeds` rows of its first cells, which sets how low it has to look; then
    it visits all further cells that may hold a row as good, and no others.
    """
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(index)
    total = queries.count()
    packs = max(1, -(-total // PACK))
    kind = ("query long, label long, v binary, asked array<struct<low:long,high:long,same:"
            "boolean>>, floors array<long>")

    def frontier(batches, first: bool):
        known = shared.value
        for batch in batches:
            out = {n: [] for n in ("left", "right", "row")}
            rows = batch.to_pylist()
            for k, row in enumerate(rows):
                vector = np.frombuffer(row["v"], np.float64)
                seen, lowest = 0, min(row["floors"])
                for bound, left, right in known.visits(_tame(vector)):
                    if bound < lowest:
                        break                               # certified: no cell can matter
                    if first and seen >= seeds:
                        break
                    seen += known.rows[left, right]
                    if not first and seen - known.rows[left, right] < seeds:
                        continue                            # seen in the first step
                    out["left"].append(left)
                    out["right"].append(right)
                    out["row"].append(k)
            for k in range(0, len(out["row"]), 4096):
                pick = pa.array(out["row"][k:k + 4096], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["left"][k:k + 4096], pa.int32()),
                     pa.array(out["right"][k:k + 4096], pa.int32()),
                     *[c.take(pick) for c in batch.columns]],
                    ["left", "right", *batch.schema.names])

    def tiles(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _tile(row, width, most)

    def step(asking: DataFrame, first: bool) -> DataFrame:
        visits = asking.mapInArrow(
            lambda batches: frontier(batches, first), f"left int, right int, {kind}")
        packed = visits.groupBy("left", "right", F.pmod(F.xxhash64("query"), F.lit(packs))
                                .alias("pack")).agg(F.collect_list(F.struct(
                                    "query", "label", "v", "asked", "floors")).alias("queries"))
        # both sides grow with the rows: never broadcast, whatever their stored size looks like
        hits = packed.hint("merge").join(blocks, ["left", "right"]).select(
            "queries", "ids", "labels", "vectors").mapInArrow(
            tiles, "query long, asked int, score long, vec_id long")
        return hits

    best = Window.partitionBy("query", "asked").orderBy(F.desc("score"), "vec_id")

    def cut(hits: DataFrame) -> DataFrame:
        return hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)

    asking = queries.select("query", "label", "v", "asked",
                            F.transform("asked", lambda x: x["low"]).alias("floors"))
    seen = common.store(cut(step(asking, True)), "seen")
    # a question that has its rows need not look below the last of them
    least = seen.where(F.col("place") == most).groupBy("query").agg(
        F.map_from_entries(F.collect_list(F.struct("asked", "score"))).alias("least"))
    floors = F.transform("asked", lambda x, i: F.greatest(
        x["low"], F.coalesce(F.element_at("least", i), x["low"])))
    further = asking.join(least, "query", "left").select(
        "query", "label", "v", "asked", floors.alias("floors"))
    both = seen.drop("place").unionByName(step(further, False))
    return common.store(cut(both), "found")


def _tile(row: dict, width: int, most: int) -> pa.RecordBatch:
    """The best rows of one block for every question of a pack."""
    asking = row["queries"]
    ids, labels = np.array(row["ids"]), np.array(row["labels"])
    score = products(matrix([q["v"] for q in asking], width),
                     np.frombuffer(row["vectors"], np.float64).reshape(-1, width))
    same = np.array([q["label"] for q in asking])[:, None] == labels[None, :]
    out = []
    for n in range(max(len(q["asked"]) for q in asking)):
        some = [k for k, q in enumerate(asking) if n < len(q["asked"])]
        low = np.array([asking[k]["floors"][n] for k in some])[:, None]
        high = np.array([asking[k]["asked"][n]["high"] for k in some])[:, None]
        want = np.array([asking[k]["asked"][n]["same"] for k in some])[:, None]
        part = score[some]
        q, r = np.nonzero((part >= low) & (part <= high) & (same[some] == want))
        order = np.lexsort((ids[r], -part[q, r], q))
        q, r = q[order], r[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, r = q[place < most], r[place < most]
        out.append((np.array([asking[some[k]]["query"] for k in q], np.int64),
                    np.full(len(q), n, np.int32), part[q, r], ids[r]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                      ["query", "asked", "score", "vec_id"])


def mine(df: DataFrame, label: Column | None = None, vec_id: str = "vec_id",
         embedding: str = "embedding", every: int = EVERY, positives: int = POSITIVES,
         negatives: int = NEGATIVES, seeds: int = SEED_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows without an id, label or vector, with null or non-finite components, or with vectors
    empty or of another length than most (of equally many, the longer) take no part. Rows of one
    id are one row, that with the least label and vector. `label` is an expression over the
    columns of `df`; others are not read. Anchors are the ids divisible by `every`; anchors with
    equal vectors and labels ask once. Of equal rows only the first can be a result, so no more
    of them are entered. A positive without negatives in its window has no row.
    """
    label = F.col("label") if label is None else label
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     common.column(whole_numbers, "binary")(
                         F.col(embedding).cast("array<double>")).alias("v"))
    rows = common.store(rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL"),
                        "numbers")
    size = rows.groupBy(F.length("v").alias("bytes")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("bytes")).first()
    if size is None:
        return df.sparkSession.createDataFrame([], RESULT)
    width = size["bytes"] // 8
    rows = rows.where(F.length("v") == size["bytes"]).groupBy("vec_id").agg(
        F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*")
    # equal rows: the anchor itself and those that can be its results
    alike = Window.partitionBy("label", "v").orderBy("vec_id")
    entered = common.store(rows.withColumn("n", F.row_number().over(alike)).where(
        F.col("n") <= max(positives + 1, negatives)).drop("n"), "rows")
    anchors = rows.where(F.col("vec_id") % every == 0)
    groups = anchors.groupBy("label", "v").agg(F.min("vec_id").alias("query"))
    anchors = common.store(anchors.join(groups, ["label", "v"]).select(
        F.col("vec_id").alias("anchor_id"), "query"), "anchors")
    groups = common.store(groups, "queries")
    index, blocks = build(entered, width)

    least, top = F.lit(-_LONG - 1), F.lit(_LONG)
    everything = F.array(F.struct(least.alias("low"), top.alias("high"),
                                  F.lit(True).alias("same")))
    found = search(groups.withColumn("asked", everything), index, blocks, width, positives + 1,
                   seeds)
    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    pairs = common.store(anchors.join(found.select("query", "score", "vec_id"), "query").where(
        F.col("vec_id") != F.col("anchor_id")).withColumn(
        "place", F.row_number().over(ranked)).where(F.col("place") <= positives).select(
        "anchor_id", "query", F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "pairs")

    # windows as whole numbers: LOW * p <= 100 * n <= HIGH * p; none below a negative p
    wide = F.col("positive_score").cast("decimal(20,0)")
    low = F.ceil(wide * LOW / 100).cast("long")
    high = F.floor(wide * HIGH / 100).cast("long")
    scores = pairs.where("positive_score >= 0").select(
        "query", "positive_score", low.alias("low"), high.alias("high")).distinct()
    asked = scores.groupBy("query").agg(F.array_sort(F.collect_list(F.struct(
        "positive_score", "low", "high"))).alias("windows"))
    asking = groups.join(asked, "query").withColumn("asked", F.transform(
        "windows", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"),
                                      F.lit(False).alias("same"))))
    asking = common.store(asking, "asking")
    hard = search(asking.drop("windows"), index, blocks, width, negatives, seeds)
    window = asking.select("query", F.posexplode("windows").alias("asked", "w")).select(
        "query", "asked", F.col("w.positive_score").alias("positive_score"))
    named = hard.join(window, ["query", "asked"]).select(
        "query", "positive_score", F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(named, ["query", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")
