"""Near-duplicates by SimHash, found with balls of fingerprints that meet half-way.

Of at most RADIUS = 3 differing bits, one half of the word has one at most: half the radius. So
every fingerprint emits, for each half, the half itself and its 32 variants at one bit. Variants
are dealt out by value; where a fingerprint's own half meets another's variant, the other halves
are compared, again by balls that meet: see `meet`. Links are stars around a fingerprint whose
own half it is, so that no group becomes a list of pairs, and every link is verified by its
differing bits. 66 variants of nine bytes are shuffled per different fingerprint.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
SHINGLE = 3
RADIUS = 3
BLOCK = 1 << 15             # fingerprints whose variants exist at a time
_MET = 1 << 15              # fingerprints of whole groups that are compared at a time
_COUNTED = 1 << 15          # hashes whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in more than half of the shingles' hashes; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED)
                          for a, b in zip(starts[:n].tolist(), stops, strict=True)),
                         np.dtype("<u8"), n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _COUNTED):
        part = hashes[k:k + _COUNTED].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint",
                     shingle: int = SHINGLE) -> DataFrame:
    """`df` with the fingerprint of the whole text as a 64-bit number (null or empty: 0)."""
    def run(values: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(x.as_py(), shingle) for x in values), np.uint64,
                            len(values))
        return pa.array(found.view(np.int64))

    return common.put(df, name, common.column(run, "long")(F.col(text)))


# Codes of what a fingerprint emits: own low half, its variants, own high half, its variants.
OWN_LOW, OWN_HIGH, CODES = 0, 33, 66
_HALF = np.uint64(0xFFFFFFFF)
_SHIFT = np.uint64(32)


@functools.lru_cache(maxsize=1)
def _flips() -> np.ndarray:
    """What each code changes in its half."""
    one = np.uint64(1) << np.arange(32, dtype=np.uint64)
    return np.r_[np.uint64(0), one, np.uint64(0), one]


@functools.lru_cache(maxsize=1)
def _pairs() -> np.ndarray:
    """Two bits of the same quarter of the word: of any three bits, two share one."""
    one = np.uint64(1) << np.arange(32, dtype=np.uint64)
    return np.array([one[i] | one[j] for i in range(32) for j in range(i)
                     if i // 16 == j // 16], np.uint64)


def variant(prints: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The half that a code stands for, with the bit flipped; which half is in the 33rd bit."""
    high = codes >= OWN_HIGH
    half = np.where(high, prints >> _SHIFT, prints & _HALF)
    return (half ^ _flips()[codes]) | (high.astype(np.uint64) << _SHIFT)


def meet(prints: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) among fingerprints that emitted the same variant.

    In the group of a variant, owners have it as their half and visitors are one bit away, so
    an owner links with what is within three bits (owners) or two (visitors) in the other half.
    Both put out that half with up to one bit flipped; owners with an odd number of ones also
    with two bits flipped. An owner within one bit of such a point is the centre of a star with
    all who are there: any two of them are as close as a link needs.
    """
    key = variant(prints, codes)
    order = np.argsort(key, kind="stable")
    key, prints, codes = key[order], prints[order], codes[order]
    owner = (codes == OWN_LOW) | (codes == OWN_HIGH)
    if not len(key):
        return prints, prints
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[first, len(key)])
    owners = np.add.reduceat(owner.astype(np.int64), first)
    keep = np.repeat((sizes > 1) & (owners > 0), sizes)
    group = np.repeat(np.arange(len(first), dtype=np.int64), sizes)[keep]
    prints, codes, owner = prints[keep], codes[keep], owner[keep]
    found = [np.zeros((2, 0), np.uint64)]
    # whole groups, so many at a time that their points stay few
    ends = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1 if len(group) else []
    a = 0
    for k, b in enumerate(ends):
        if b - a >= _MET or k == len(ends) - 1:
            found.append(_stars(group[a:b], prints[a:b], codes[a:b], owner[a:b]))
            a = b
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return both[0], both[1]


def _stars(group, prints, codes, owner) -> np.ndarray:
    other = np.where(codes >= OWN_HIGH, prints & _HALF, prints >> _SHIFT)
    n, one, two = len(prints), _flips()[:33], _pairs()
    odd = np.flatnonzero(owner & (np.bitwise_count(other) % 2 == 1))
    at = np.r_[np.repeat(np.arange(n), 33), np.repeat(odd, len(two))]
    point = np.r_[(other[:, None] ^ one).ravel(), (other[odd, None] ^ two).ravel()]
    near = np.r_[np.repeat(owner, 33), np.zeros(len(odd) * len(two), bool)]
    order = np.lexsort((prints[at], ~near, point, group[at]))
    at, point, near = at[order], point[order], near[order]
    where = group[at]
    first = np.flatnonzero(np.r_[True, (point[1:] != point[:-1]) | (where[1:] != where[:-1])])
    centre = np.repeat(first, np.diff(np.r_[first, len(at)]))
    x, y = prints[at[centre]], prints[at]
    good = near[centre] & (x != y) & (np.bitwise_count(x ^ y) <= RADIUS)
    return np.unique(np.stack([x[good], y[good]]), axis=1)


def links(classes: DataFrame, partitions: int) -> DataFrame:
    """Edges (a, b) among the different fingerprints in `print` that are within three bits.

    Variants travel as arrays, nine bytes each, dealt out evenly by a hash of the variant.
    """
    def emit(batches):
        for batch in batches:
            table = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(table), BLOCK):
                part = np.repeat(table[k:k + BLOCK], CODES)
                code = np.tile(np.arange(CODES, dtype=np.uint8), len(part) // CODES)
                to = (variant(part, code) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) \
                    % np.uint64(partitions)
                order = np.argsort(to, kind="stable")
                ends = np.r_[0, np.cumsum(np.bincount(to.astype(np.int64),
                                                      minlength=partitions))]
                for p in range(partitions):
                    mine = order[ends[p]:ends[p + 1]]
                    if len(mine):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([p], pa.int32()),
                            pa.array([part[mine].tobytes()], pa.binary()),
                            pa.array([code[mine].tobytes()], pa.binary())],
                            ["p", "prints", "codes"])

    def gather(batches):
        prints, codes = [], []
        for batch in batches:
            prints += [np.frombuffer(x, np.uint64) for x in batch.column("prints").to_pylist()]
            codes += [np.frombuffer(x, np.uint8) for x in batch.column("codes").to_pylist()]
        if prints:
            a, b = meet(np.concatenate(prints), np.concatenate(codes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    blobs = classes.select("print").mapInArrow(emit, "p int, prints binary, codes binary")
    return blobs.repartitionById(partitions, "p").mapInArrow(gather, "a long, b long")


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, print, component_id) of every row: the smallest id that links lead to.

    Rows with an empty or null text have fingerprint 0, which links like any other. Rows of one
    id are one document. A row without an id links nothing; it is given the component of its
    fingerprint, if a row with an id has the same. No other column is read.
    """
    spark = df.sparkSession
    prints = common.store(
        with_fingerprint(df.select(F.col(text).alias("text"),
                                   F.col(doc_id).cast("long").alias("doc_id")), "text", "print")
        .select("doc_id", "print"), "prints")
    classes = common.store(prints.where("doc_id IS NOT NULL").groupBy("print").agg(
        F.min("doc_id").alias("owner")), "classes")
    found = common.store(links(classes, common.shuffle_partitions(spark)).distinct(), "links")
    for end in ("a", "b"):
        names = classes.select(F.col("print").alias(end), F.col("owner").alias(f"{end}_owner"))
        found = found.join(names, end)
    found = found.select(F.col("a_owner").alias("a"), F.col("b_owner").alias("b"))
    same = prints.where("doc_id IS NOT NULL").join(classes, "print").where(
        "doc_id <> owner").select(F.col("doc_id").alias("a"), F.col("owner").alias("b"))
    repeated = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    same = same.join(repeated.select(F.col("doc_id").alias("a")), "a", "left_semi")
    parts = common.components(found.union(same))
    labels = common.store(classes.join(parts, F.col("owner") == F.col("node"), "left").select(
        "print", F.coalesce("component", "owner").alias("component_id")), "labels")
    return prints.join(labels, "print", "left").select("doc_id", "print", "component_id")
