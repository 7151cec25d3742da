"""Language of a document by rank-order profiles of character n-grams.

A profile is the most frequent n-grams of a language, in order. A document's own order is
compared with each profile: the sum of the places its n-grams are out of. The language with
the least sum is taken.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Bound of the labelled sample: about so many different texts of a language, chosen by a hash.
SAMPLE_DOCUMENTS = 2000
PROFILE_GRAMS = 400
LENGTHS = (1, 2, 3)
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each 16-bit code unit; a space for what is no letter."""
    out = np.full(65536, 32, np.uint16)
    for code in range(65536):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 and ord(low) < 65536 else code
        elif 0xD800 <= code < 0xE000:
            out[code] = code
    return out


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram, count), in order of text and n-gram. N-grams cross no text."""
    table, owners, codes = _letters(), [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        unit = table[np.frombuffer(f" {text} ".encode("utf-16-le", "replace"), np.uint16)]
        unit = unit[np.r_[True, (unit[1:] != 32) | (unit[:-1] != 32)]].astype(np.uint64)
        if len(unit) < 3:
            continue
        for n in LENGTHS:
            gram = unit[:len(unit) - n + 1].copy()
            for k in range(1, n):
                gram = (gram << np.uint64(16)) | unit[k:len(unit) - n + 1 + k]
            found, count = np.unique(gram[gram != 32], return_counts=True)
            owners.append(np.full(len(found), i, np.int64))
            codes.append(np.stack([found, count.astype(np.uint64)]))
    if not owners:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    both = np.concatenate(codes, axis=1)
    return np.concatenate(owners), both[0], both[1].astype(np.int64)


def ranked(owner, gram, count, most: int):
    """The `most` most frequent n-grams of each owner with their rank; ties by n-gram."""
    order = np.lexsort((gram, -count, owner))
    owner, gram = owner[order], gram[order]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)])) \
        if len(owner) else np.zeros(0, np.int64)
    keep = rank < most
    return owner[keep], gram[keep], rank[keep]


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang",
          sample: int = SAMPLE_DOCUMENTS, most: int = PROFILE_GRAMS) -> dict[str, list[int]]:
    """Profiles: the n-grams of each language, most frequent first.

    Learnt from about `sample` different texts of each language, chosen by a hash of the text;
    repeated texts count once, and rows with a null text or language teach nothing. What reaches the driver is `most` numbers for
    each language.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    hashed = F.xxhash64("text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.select("lang", hashed.alias("h")).distinct()
              .groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, sample / n)])
    place = F.pmod(hashed, F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.where(place < share[F.col("lang")]).distinct()

    def count(batches):
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for a, b in common.pieces(batch.column("text"), 1 << 20):
                owner, gram, n = grams(batch.column("text").slice(a, b - a).to_pylist())
                held: dict[str, list] = {}
                for name in set(names[a:b]):
                    mine = np.array([x == name for x in names[a:b]])[owner]
                    if mine.any():
                        found, at = np.unique(gram[mine], return_inverse=True)
                        held[name] = [found, np.bincount(at, n[mine]).astype(np.int64)]
                for name, (found, total) in held.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found)), pa.array(found.astype(np.int64)),
                         pa.array(total)], ["lang", "gram", "n"])

    totals = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    best = totals.withColumn("place", F.expr(
        "row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram)")).where(
        F.col("place") <= most)
    profiles: dict[str, list[tuple[int, int]]] = {k: [] for k in counts}
    for r in best.collect():
        profiles[r["lang"]].append((r["place"], r["gram"]))
    return {k: [g for _, g in sorted(v)] for k, v in sorted(profiles.items()) if v}


class Model:
    """Profiles as one table of n-grams, with the place of each in every language."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.names = sorted(profiles)
        self.most = max([len(p) for p in profiles.values()], default=0)
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
        self.places = np.full((len(self.grams) + 1, len(self.names)), self.most, np.int32)
        for k, name in enumerate(self.names):
            own = np.array(profiles[name], np.uint64)
            self.places[np.searchsorted(self.grams, own), k] = np.arange(len(own))

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.names:
            return names, scores
        owner, gram, rank = ranked(*grams(texts), self.most)
        if not len(owner):
            return names, scores
        at = np.searchsorted(self.grams, gram)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != gram] = len(self.grams)
        known = self.places[at]
        off = np.where(known < self.most, np.abs(known - rank[:, None]), self.most)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        total = np.add.reduceat(off, first, axis=0)
        worst = np.diff(np.r_[first, len(owner)]) * self.most
        for i, k, low, most in zip(owner[first], total.argmin(1), total.min(1), worst,
                                   strict=True):
            if _has_letter(texts[i]):
                names[i], scores[i] = self.names[k], 1 - float(low) / float(most)
        return names, scores


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def predict(df: DataFrame, profiles: dict[str, list[int]], text: str = "text") -> DataFrame:
    """`df` with lang_pred and score (0 to 1); `und` and 0 if the text is null or has no letter.

    Equal sums: the language that comes first in the alphabet. Without profiles all is `und`.
    Columns named like the results are replaced.
    """
    def run(values: pa.Array) -> pa.Array:
        model, names, scores = Model(profiles), [], []
        for a, b in common.pieces(values, 1 << 20):
            n, s = model.judge(values.slice(a, b - a).to_pylist())
            names += n
            scores += s
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            ["lang_pred", "score"])

    out = df.withColumn("__lang", common.column(run, "lang_pred string, score double")(
        F.col(text)))
    return out.withColumns({c: F.col(f"__lang.{c}") for c in ("lang_pred", "score")}).drop(
        "__lang")


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of documents that nothing is learnt from; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))
