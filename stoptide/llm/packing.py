"""Packing of documents into sequences of a fixed number of tokens by a grouping genetic algorithm.

Documents are encoded once; longer ones are cut. Pieces that fill a sequence are one. The others
are dealt out to groups of a bounded number, and every group is packed by itself: islands hold
populations of packings, whose crossover injects whole well-filled sequences of one parent into
the other, drops the sequences that would hold a piece twice, and puts the pieces displaced by
that where they fit best. Between epochs the best packing of an island migrates to the next one.
The worst sequences of a group are opened again, and their pieces are packed anew together with
those of other groups, until one group is left.
"""

from __future__ import annotations

import base64
import functools
import random
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY = 1024
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}          # the tokenizer file's special token (fixed value)
END = 2
GROUP = 8192                # pieces that are packed together, on average; below 2 ** 15
ISLANDS, POPULATION = 2, 4
EPOCHS, CHILDREN = 3, 32    # epochs of a level; children of an island in one of them
OPENED = 8                  # one of so many sequences of a group is opened for the next level
_LEVELS, _PLACES = 32, 1 << 16


# -- documents to pieces

@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens=SPECIAL)


def encoder(path: str | None = None):
    """Text to ids, as the tokenizer of the same vocabulary gives them without added tokens.

    Its special token is one id wherever its string stands in a text.
    """
    import public_tokenizers

    coder = _encoding(path or public_tokenizers.path(RANKS), public_tokenizers.PATTERN)

    def encode(text: str) -> list[int]:
        if any(s in text for s in SPECIAL):
            return coder.encode(text, allowed_special="all")
        return coder.encode_ordinary(text)

    return encode


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `n` ids; the first takes what the others leave."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((k, capacity) for k in range(first, n, capacity))]


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row; a null text is empty.

    Ids end with END. Repeated rows give repeated pieces; other columns are not read.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())]
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        ddl += ", ids array<int>"
    schema = pa.schema(fields)

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(words.as_py() or ""), END], "<u4")
                for n, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = (doc, n, start, length, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema,
                                                     strict=True)]
                if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, ddl)


# -- one group: items are numbers into `sizes`, longest first

class Packing:
    """Bins of items, and how full they are."""

    def __init__(self, bins: list[tuple[int, ...]], fill: list[int]):
        self.bins, self.fill = bins, fill

    @functools.cached_property
    def where(self) -> dict[int, int]:
        return {i: k for k, b in enumerate(self.bins) for i in b}

    @functools.cached_property
    def emptiest(self) -> list[int]:
        return sorted(range(len(self.fill)), key=self.fill.__getitem__)

    @functools.cached_property
    def worth(self) -> tuple[int, int]:
        """Less is better: fewer bins; of as many, those that are more unevenly filled."""
        return len(self.bins), -sum(f * f for f in self.fill)

    def genes(self, n: int) -> bytes:
        """The bin of every item."""
        out = np.empty(n, np.uint16)
        for k, b in enumerate(self.bins):
            out[list(b)] = k
        return out.tobytes()

    @classmethod
    def of(cls, genes: bytes, sizes: Sequence[int]) -> Packing:
        bins: dict[int, list[int]] = {}
        for i, k in enumerate(np.frombuffer(genes, np.uint16).tolist()):
            bins.setdefault(k, []).append(i)
        return cls([tuple(b) for b in bins.values()],
                   [sum(sizes[i] for i in b) for b in bins.values()])


def best_fit(packing: Packing, items: Sequence[int], sizes: Sequence[int], capacity: int) -> None:
    """Put every item into the bin that it leaves the least room in, or into a new one.

    The rooms that some bin has are the bits of a number, so the least that is enough is its
    lowest bit from the size on.
    """
    bins, fill = packing.bins, packing.fill
    rooms: dict[int, list[int]] = {}
    mask = 0
    for k, f in enumerate(fill):
        rooms.setdefault(capacity - f, []).append(k)
    for room in rooms:
        mask |= 1 << room
    for i in items:
        size = sizes[i]
        enough = mask >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            k = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
            bins[k] += (i,)
            fill[k] += size
            room -= size
        else:
            k, room = len(bins), capacity - size
            bins.append((i,))
            fill.append(size)
        rooms.setdefault(room, []).append(k)
        mask |= 1 << room


def least_bins(sizes: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: items above a limit each need one, and what the smaller ones
    need beyond the room that is left there (Martello and Toth)."""
    if not len(sizes):
        return 0
    counts = np.bincount(sizes, minlength=capacity + 1)
    weight = counts * np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(weight)
    best = -(-int(total[-1]) // capacity)
    for limit in range(1, capacity // 2 + 1):
        alone = number[-1] - number[capacity - limit]       # larger than capacity - limit
        half = number[capacity - limit] - number[capacity // 2]
        held = total[capacity - limit] - total[capacity // 2]
        small = total[capacity // 2] - total[limit - 1]
        rest = small - (half * capacity - held)
        best = max(best, int(alone + half + max(0, -(-rest // capacity))))
    return best


def crossover(one: Packing, other: Packing, sizes: Sequence[int], capacity: int,
              rng: random.Random) -> Packing:
    """A child of two packings: whole well-filled bins of `other` in `one`.

    Bins of `one` that share an item with them go, and a few of the emptiest (mutation); the
    items displaced by that are fitted in again, mostly longest first.
    """
    well = other.emptiest[len(other.fill) // 2:]
    injected = [other.bins[k] for k in rng.sample(well, rng.randint(1, 1 + len(well) // 8))]
    inside = {i for b in injected for i in b}
    gone = {one.where[i] for i in inside}
    gone.update(one.emptiest[:rng.randint(1, 1 + len(one.fill) // 32)])
    displaced = [i for k in gone for i in one.bins[k] if i not in inside]
    noise = rng.choice((0, 0, 8, 64))
    displaced.sort(key=lambda i: i + rng.random() * noise)
    kept = [k for k in range(len(one.fill)) if k not in gone]
    child = Packing(injected + [one.bins[k] for k in kept],
                    [sum(sizes[i] for i in b) for b in injected] + [one.fill[k] for k in kept])
    best_fit(child, displaced, sizes, capacity)
    return child


def found(sizes: Sequence[int], capacity: int, size: int, goal: int, rng: random.Random
          ) -> list[Packing]:
    """A population: best fit from the longest on, and in orders with more and more disorder."""
    out: list[Packing] = []
    for k in range(size):
        noise = 0.005 * 4 ** k * len(sizes) if k else 0
        order = sorted(range(len(sizes)), key=lambda i: i + rng.random() * noise)
        out.append(Packing([], []))
        best_fit(out[-1], order, sizes, capacity)
        if len(out[-1].bins) <= goal:
            break
    return out


def evolve(population: list[Packing], sizes: Sequence[int], capacity: int, goal: int,
           children: int, rng: random.Random) -> list[Packing]:
    """The population after `children` crossovers, the best first; ends early at the goal.

    Parents are drawn, the better of two is the one that is changed; a child replaces the worst.
    """
    ranked = sorted(population, key=lambda p: p.worth)
    for _ in range(children):
        if len(ranked[0].bins) <= goal or len(ranked) < 2:
            break
        one, other = sorted(rng.sample(range(len(ranked)), 2))
        child = crossover(ranked[one], ranked[other], sizes, capacity, rng)
        if child.worth < ranked[-1].worth:
            ranked[-1] = child
            ranked.sort(key=lambda p: p.worth)
    return ranked


# -- all groups

_STATE = pa.schema([("grp", pa.int64()), ("island", pa.int32()), ("n", pa.int32()),
                    ("bins", pa.int32()), ("goal", pa.int32()), ("load", pa.int64()),
                    ("sizes", pa.binary()), ("genes", pa.binary())])
_STATE_DDL = ("grp long, island int, n int, bins int, goal int, load long, sizes binary, "
              "genes binary")


def _rows(grp: int, island: int, goal: int, sizes: np.ndarray, population: list[Packing]
          ) -> list[dict]:
    return [{"grp": grp, "island": island, "n": k, "bins": len(p.bins), "goal": goal,
             "load": p.worth[1], "sizes": sizes.tobytes(), "genes": p.genes(len(sizes))}
            for k, p in enumerate(population)]


def _islands(grouped: DataFrame, level: int, capacity: int) -> DataFrame:
    """The first populations of every group."""
    def start(key, table):
        grp = key[0].as_py()
        sizes = np.sort(table.column("length").to_numpy())[::-1].astype(np.uint16)
        goal = least_bins(sizes, capacity)
        out = []
        for island in range(ISLANDS):
            rng = random.Random(f"{level} {grp} {island}")
            population = found(sizes.tolist(), capacity, POPULATION, goal, rng)
            out += _rows(grp, island, goal, sizes, population)
            if len(population[-1].bins) <= goal:
                break
        return pa.Table.from_pylist(out, _STATE)

    return grouped.select("grp", "length").groupBy("grp").applyInArrow(start, _STATE_DDL)


def _epoch(state: DataFrame, level: int, epoch: int, capacity: int) -> DataFrame:
    """Every island's population after some crossovers; its best packing also migrates."""
    def run(key, table):
        grp, island = (k.as_py() for k in key)
        rows = table.to_pylist()
        sizes, goal = np.frombuffer(rows[0]["sizes"], np.uint16), rows[0]["goal"]
        rng = random.Random(f"{level} {grp} {island} {epoch}")
        listed = sizes.tolist()
        rows.sort(key=lambda r: (r["bins"], r["load"], r["n"]))
        population = evolve([Packing.of(r["genes"], listed) for r in rows[:POPULATION]], listed,
                            capacity, goal, CHILDREN, rng)
        out = _rows(grp, island, goal, sizes, population)
        if ISLANDS > 1:
            out.append(out[0] | {"island": (island + 1) % ISLANDS, "n": POPULATION})
        return pa.Table.from_pylist(out, _STATE)

    return state.groupBy("grp", "island").applyInArrow(run, _STATE_DDL)


def _solve(grouped: DataFrame, level: int, capacity: int) -> DataFrame:
    """(grp, genes): the best packing of each group. Groups at their goal evolve no further."""
    state = common.store(_islands(grouped, level, capacity), "islands")
    solved = []
    for epoch in range(EPOCHS + 1):
        best = common.store(state.groupBy("grp").agg(F.min_by(
            F.struct("bins", "goal", "genes"), F.struct("bins", "load", "island", "n"))
            .alias("b")).select("grp", "b.*"), "best")
        open_groups = best.where("bins > goal").select("grp")
        if epoch == EPOCHS or open_groups.isEmpty():
            solved.append(best)
            break
        solved.append(best.where("bins <= goal"))
        alive = state.join(open_groups, "grp", "left_semi")
        state = common.store(_epoch(alive, level, epoch, capacity), "islands")
    out = solved[0]
    for s in solved[1:]:
        out = out.unionByName(s)
    return out.select("grp", "genes")


def _place(grouped: DataFrame, best: DataFrame, last: bool, capacity: int) -> DataFrame:
    """Every row with its sequence and offset in it; `opened` if it is packed again."""
    names = [*grouped.columns, "bin", "offset", "opened"]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in grouped.schema]
    ddl = ", ".join([*kinds, "bin int, offset long, opened boolean"])

    def run(table, genes):
        table = table.sort_by([("length", "descending"), ("item", "ascending")])
        sizes = table.column("length").to_numpy()
        bins = np.frombuffer(genes.column("genes")[0].as_py(), np.uint16).astype(np.int64)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        opened = np.zeros(len(fill), bool)
        if not last:
            opened[np.argsort(fill, kind="stable")[:-(-len(fill) // OPENED)]] = True
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        starts = np.r_[0, np.cumsum(fill)[:-1]]
        offset = np.empty(len(sizes), np.int64)
        offset[order] = ends - sizes[order] - starts[bins[order]]
        for name, values in (("bin", bins.astype(np.int32)), ("offset", offset),
                             ("opened", opened[bins])):
            table = table.append_column(name, pa.array(values))
        return table.select(names)

    return grouped.groupBy("grp").cogroup(best.groupBy("grp")).applyInArrow(run, ddl)


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """`cut` (see `pieces`) with sequence_id and offset: the sequence of a piece, and its place.

    Pieces lie in a sequence one after the other, from 0 on. Which group a piece comes into
    depends on a hash of its row, so copies and a hot source are dealt out evenly. Each level
    has about an eighth of the pieces of the one before; the last is a single group.
    """
    rows = common.store(cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    names = ["item", *cut.columns]
    # odd numbers for whole sequences; even ones name the level, the group and the place in it
    out = [rows.where(F.col("length") >= capacity).select(
        *names, (F.col("item") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))]
    open_rows = rows.where(F.col("length") < capacity)
    for level in range(_LEVELS):
        total = open_rows.count()
        if not total:
            break
        groups = -(-total // group)
        grouped = open_rows.withColumn("grp", F.pmod(
            F.xxhash64("item", F.lit(level)), F.lit(groups)).cast("long"))
        best = _solve(grouped, level, capacity)
        placed = common.store(_place(
            grouped.select(*names, "grp"), best, groups == 1 or level == _LEVELS - 1, capacity), "placed")
        number = ((F.col("grp") * _PLACES + F.col("bin")) * _LEVELS + level) * 2
        out.append(placed.where("NOT opened").select(
            *names, number.alias("sequence_id"), "offset"))
        open_rows = placed.where("opened").select(*names)
    found_rows = out[0]
    for part in out[1:]:
        found_rows = found_rows.unionByName(part)
    return found_rows.drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, for pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
