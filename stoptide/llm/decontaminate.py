"""Benchmark decontamination: windows of test items in training texts.

Windows of test words are kept in a hash table that goes to every task. Texts are cut into
words and hashed as arrays; windows whose hash is in the table are compared word by word. Items
are taken in blocks of a bounded size, each one broadcast and one scan, so the table in a task
does not grow with the benchmark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
BLOCK_BYTES = 16 << 20      # text of the items of one broadcast
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# bytes of words: digits, a-z, and all of a character beyond ASCII; A-Z count as a-z
_WORD = np.array([chr(b).isdigit() or chr(b).isalpha() if b < 128 else True
                  for b in range(256)])
_VALUE = np.random.default_rng(13).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_LONG = 8 << 20             # bytes of a text that are hashed at a time


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(0, n - 1), base)])


_POWER, _INVERSE = _powers(_ODD, 1), _powers(_BACK, 1)


def _grow(n: int) -> None:
    global _POWER, _INVERSE
    if len(_POWER) < n:
        _POWER, _INVERSE = _powers(_ODD, n), _powers(_BACK, n)


def words(data: np.ndarray, cuts: np.ndarray | None = None):
    """(starts, ends, hashes) of the words of a byte array; a word does not cross a cut."""
    mask = np.zeros(len(data) + 2, bool)
    mask[1:-1] = _WORD[data]
    rises = mask[1:] & ~mask[:-1]
    falls = mask[:-1] & ~mask[1:]
    if cuts is not None and len(cuts):
        inside = cuts[(cuts > 0) & (cuts < len(data))]
        inside = inside[mask[inside] & mask[inside + 1]]
        rises[inside] = falls[inside] = True
    starts, ends = np.flatnonzero(rises), np.flatnonzero(falls)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    _grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _POWER[:len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _INVERSE[starts]
    hashes ^= hashes >> np.uint64(29)
    return starts, ends, hashes * _ODD


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * _BACK + hashes[k:k + n]
    return out ^ (out >> np.uint64(31))


class Windows:
    """The windows of some items: by length, sorted hashes; by words, the items."""

    def __init__(self, items: list[tuple[int | str | None, str | None]], window: int = WINDOW):
        self.items: dict[bytes, set] = {}
        held: dict[int, set[int]] = {}
        for item, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            starts, ends, hashes = words(data)
            if not len(starts):
                continue
            low = data.tobytes().lower()
            found = [low[a:b] for a, b in zip(starts, ends, strict=True)]
            length = min(window, len(found))
            for i, h in enumerate(window_hashes(hashes, length).tolist()):
                self.items.setdefault(b" ".join(found[i:i + length]), set()).add(item)
                held.setdefault(length, set()).add(h)
        self.hashes = {k: np.sort(np.array(list(v), np.uint64)) for k, v in held.items()}
        self.filters = {}
        for k, v in self.hashes.items():
            self.filters[k] = np.zeros(1 << 16, bool)
            self.filters[k][v & np.uint64(0xFFFF)] = True

    def hits(self, data: bytes, starts, ends, hashes):
        """(first word, number of words, items) of the windows of one stretch of words."""
        for length, table in self.hashes.items():
            found = window_hashes(hashes, length)
            at = np.flatnonzero(self.filters[length][found & np.uint64(0xFFFF)])
            if not len(at):
                continue
            place = np.searchsorted(table, found[at])
            place[place == len(table)] = 0
            for i in at[table[place] == found[at]].tolist():
                key = b" ".join([data[a:b].lower() for a, b in zip(
                    starts[i:i + length].tolist(), ends[i:i + length].tolist(), strict=True)])
                items = self.items.get(key)
                if items is not None:
                    yield i, length, items


_held: dict[int, tuple] = {}


def _table(shared, window: int) -> Windows:
    """The table of a broadcast, built once in a Python worker."""
    if id(shared) not in _held:
        _held.clear()
        _held[id(shared)] = (shared, Windows(shared.value, window))
    return _held[id(shared)][1]


def _stretches(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of at most about _LONG bytes that end where no word does."""
    out, a = [], 0
    while len(text) - a > _LONG:
        b = a + _LONG
        while b < len(text) and _WORD[text[b]]:
            b += 1
        out.append((a, b))
        a = b
    return [*out, (a, len(text))]


def scan_texts(values: pa.Array, table: Windows, most: int) -> list[tuple[int, list, set]]:
    """(number of words, hit ranges of words, items) of each text."""
    out = []
    for a, b in common.pieces(values):
        texts = [(x.as_py() or "").encode() for x in values.slice(a, b - a)]
        if len(texts) > 1:
            data = b"".join(texts)
            cuts = np.cumsum([len(x) for x in texts])
            starts, ends, hashes = words(np.frombuffer(data, np.uint8), cuts)
            borders = np.searchsorted(starts, np.r_[0, cuts])
            held = [(borders[k + 1] - borders[k], [], set()) for k in range(len(texts))]
            for i, length, items in table.hits(data, starts, ends, hashes):
                k = int(np.searchsorted(borders, i, side="right")) - 1
                if i + length <= borders[k + 1]:
                    held[k][1].append((i - int(borders[k]), i - int(borders[k]) + length))
                    held[k][2].update(items)
            out += held
            continue
        # one text: piece by piece, with the last words of a piece before the next
        total, ranges, items = 0, [], set()
        carry = (b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        for x, y in _stretches(texts[0]):
            part = texts[0][x:y]
            starts, ends, hashes = words(np.frombuffer(part, np.uint8))
            shift, before = len(carry[0]), len(carry[1])
            data = carry[0] + part
            starts = np.r_[carry[1], starts + shift]
            ends = np.r_[carry[2], ends + shift]
            hashes = np.r_[carry[3], hashes]
            for i, length, names in table.hits(data, starts, ends, hashes):
                if i + length > before:
                    ranges.append((total - before + i, total - before + i + length))
                    items.update(names)
            total += len(starts) - before
            keep = starts[-(most - 1):] if most > 1 else starts[:0]
            cut = int(keep[0]) if len(keep) else len(data)
            carry = (data[cut:], keep - cut, ends[len(ends) - len(keep):] - cut,
                     hashes[len(hashes) - len(keep):])
        out.append((total, ranges, items))
    return out


def _merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def item_blocks(benchmark: DataFrame, text: str, item_id: str, limit: int, window: int = WINDOW):
    """Lists of (item, text) of about `limit` bytes at most; longer texts are cut, overlapping
    by all but one word of a window.

    Sizes are added up by Spark first, so that each collected list is bounded. Repeated pairs
    are dropped before, as all copies would fall into one list.
    """
    cut = max(1024, limit // 8)

    def parts(batches):
        for batch in batches:
            for item, value in zip(batch.column("item").to_pylist(),
                                   batch.column("text").to_pylist(), strict=True):
                raw = (value or "").encode()
                if len(raw) <= cut:
                    yield item, value or ""
                    continue
                starts, ends, _ = words(np.frombuffer(raw, np.uint8))
                a = 0
                while a < len(starts):
                    b = max(a + window, int(np.searchsorted(starts, starts[a] + cut)))
                    b = min(b, len(starts))
                    yield item, raw[starts[a]:ends[b - 1]].decode()
                    if b == len(starts):
                        break
                    a = b - window + 1

    def run(batches):
        for item, value in parts(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([item], pa.string()), pa.array([value], pa.string())],
                ["item", "text"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"),
                            F.col(text).alias("text")).where("text IS NOT NULL")
    rows = common.store(rows.mapInArrow(run, "item string, text string").distinct(), "items")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = 1 + int(2 * total // limit)
    for k in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"], r["text"]) for r in mine.collect()]


def scan(df: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text",
         item_id: str = "item_id", window: int = WINDOW, name: str = "scan",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`df` with `scan`: n_words, hit ranges of words (`spans`), n_hit, items.

    A null text has no words and no hits. An item of fewer than `window` words, but not none, is
    one window. Items with a null id mark words, but are not listed; repeated items count once.
    A column of the result's name is replaced, all others are kept.
    """
    kind = "struct<n_words:long,n_hit:long,spans:array<array<long>>,items:array<string>>"
    for k, items in enumerate(
            item_blocks(benchmark, bench_text, item_id, block_bytes, window)):
        shared = df.sparkSession.sparkContext.broadcast(items)
        if k > 1:
            df = common.store(df, "scan")       # one table in a task at a time

        def run(values: pa.Array, before: pa.Array | None = None, shared=shared) -> pa.Array:
            table = _table(shared, window)
            found = scan_texts(values, table, window)
            rows = []
            for i, (n, ranges, names) in enumerate(found):
                names = {x for x in names if x is not None}
                if before is not None:
                    old = before[i].as_py()
                    ranges = ranges + [tuple(r) for r in old["spans"]]
                    names |= set(old["items"])
                spans = _merged(ranges)
                rows.append({"n_words": int(n), "n_hit": sum(b - a for a, b in spans),
                             "spans": spans, "items": sorted(names)})
            return pa.array(rows, pa.struct([
                ("n_words", pa.int64()), ("n_hit", pa.int64()),
                ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))]))

        if k:
            df = df.withColumn(name, common.column(
                lambda v, b, run=run: run(v, b), kind)(F.col(text), F.col(name)))
        else:
            df = df.withColumn(name, common.column(
                lambda v, run=run: run(v), kind)(F.col(text)))
    return df


def contaminated(found: Column) -> Column:
    """At least one hit, and at least a twentieth of the words hit."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def items_digest(found: Column) -> Column:
    return F.sha2(F.array_join(found["items"], ","), 256)


def without_spans(df: DataFrame, text: str = "text", name: str = "scan") -> DataFrame:
    """`df` with the hit words cut out of the text."""
    def run(values: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for value, scalar in zip(values, found, strict=True):
            raw, spans = value.as_py(), scalar.as_py()["spans"]
            if raw is not None and spans:
                data = raw.encode()
                starts, ends, _ = words(np.frombuffer(data, np.uint8))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:starts[a]])
                    at = int(ends[b - 1])
                raw = b"".join([*kept, data[at:]]).decode()
            out.append(raw)
        return pa.array(out, pa.string())

    return df.withColumn(text, common.column(run, "string")(F.col(text), F.col(name)))

