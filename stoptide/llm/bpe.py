"""Byte-pair encoding and decoding with the merge table of a public tokenizer.

A piece of text is a doubly linked list of symbols; a heap holds the pairs that can be merged,
by rank and place. Entries whose symbols have changed since are skipped. Decoding puts the
vocabulary strings of the ids together.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MODEL = "word_bpe_49k.json"
CACHE_BYTES = 128 << 20     # of remembered words, in each of two generations
_ENTRY_BYTES = 360          # of one of them, besides its letters
_ID_BITS = 32
# Bits of a place in a queue's entries; with few, an entry is a number that is quick to compare.
_FEW, _MANY = 14, 40
# White space of Unicode, as ranges (fixed values).
SPACES = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
          (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
          (0x3000, 0x3000)]
# The splitting pattern of the vocabulary (fixed value), and the same for texts without other
# numbers than decimal digits, in the terms of a faster matcher.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SPACE = "".join(f"{chr(a)}-{chr(b)}" for a, b in SPACES)

SIMPLE = rf"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\w{SPACE}]|_)+"


def byte_characters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in kept}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(kept))
    return out


class Encoder:
    """Encodes as the tokenizer file says, without its truncation, padding and extra tokens.

    Understands lower-casing word BPE: NFC, white space, lower case; a splitting pattern; bytes;
    merges with a suffix for word ends; tokens that are cut out of the raw text first.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        # the merges by the ids of their two symbols; ids beyond the vocabulary are unknown
        self.ranks, self.merged = {}, []
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = self.vocab[left], self.vocab[right]
            self.ranks[a << _ID_BITS | b] = rank
            self.merged.append(self.vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {
            i: s for s, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        pattern = splitter["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", SPACE)).findall
        self.simple = re.compile(SIMPLE).findall if pattern == PATTERN else self.words
        self.bytes = byte_characters()
        self.unknown = max(self.strings) + 1
        self.inner, self.final = (
            [self.vocab.get(self.bytes[b] + end, self.unknown) for b in range(256)]
            for end in ("", self.suffix))
        self.remembered = _Words(self.word)

    def normalise(self, text: str) -> str:
        """NFC and lower case, by single characters: no final sigma.

        White space is dropped by the splitting pattern, so it is not made uniform first.
        """
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def split(self, text: str) -> list[str]:
        plain = text.isascii() or _other_numbers().isdisjoint(text)
        return (self.simple if plain else self.words)(text)

    def merge(self, word: str) -> list[int]:
        """Ids of one piece of text; symbols that the vocabulary lacks are left out."""
        raw = word.encode()
        n = len(raw)
        if not n:
            return []
        ids = [*map(self.inner.__getitem__, raw[:-1]), self.final[raw[-1]]]
        rank_of, merged = self.ranks.get, self.merged
        # the rank of the pair that begins at each place; entries with another are stale
        now = [rank_of(a << _ID_BITS | b, -1) for a, b in itertools.pairwise(ids)]
        now.append(-1)
        bits = _FEW if n < 1 << _FEW else _MANY
        places = (1 << bits) - 1
        queue = [rank << bits | i for i, rank in enumerate(now) if rank >= 0]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            rank, i = entry >> bits, entry & places
            if now[i] != rank:
                continue
            j = after[i]
            mine = ids[i] = merged[rank]
            ids[j] = now[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = now[i] = rank_of(mine << _ID_BITS | ids[k], -1)
                if new >= 0:
                    push(queue, new << bits | i)
            else:
                now[i] = -1
            h = before[i]
            if h >= 0:
                new = now[h] = rank_of(ids[h] << _ID_BITS | mine, -1)
                if new >= 0:
                    push(queue, new << bits | h)
        unknown = self.unknown
        return [i for i in ids if 0 <= i < unknown]

    def decode(self, ids: list[int]) -> str:
        """The strings of the ids, joined by a space, as this file names no decoder."""
        return " ".join([self.strings[i] for i in ids])

    def word(self, word: str) -> tuple[str, str]:
        """The ids of one piece of text, and what they decode to, joined by spaces."""
        ids = self.merge(word)
        return " ".join(map(str, ids)), self.decode(ids)

    def spaced(self, text: str) -> tuple[str, str]:
        """The ids and the decoded text, each joined by a space."""
        ids, texts = [], []
        parts = self.cut.split(text) if "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(str(self.special[part]))
                texts.append(part)
            elif part:
                found = [*map(self.remembered.__getitem__, self.split(self.normalise(part)))]
                ids += [i for i, _ in found if i]
                texts += [t for i, t in found if i]
        self.remembered.trim()
        return " ".join(ids), " ".join(texts)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.spaced(text)[0].split()]


class _Words(dict):
    """What a function makes of words: ids and decoded text, in one entry.

    Two generations, each bounded by its bytes: words in use stay, others go with the older one.
    `trim` is called between texts, so the words of one text may be held beyond the bound.
    """

    def __init__(self, make, limit: int | None = None):
        super().__init__()
        self.make, self.older, self.held = make, {}, 0
        self.limit = CACHE_BYTES if limit is None else limit

    def __missing__(self, word: str) -> tuple[str, str]:
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        self[word] = found
        self.held += len(word) + len(found[0]) + len(found[1]) + _ENTRY_BYTES
        return found

    def trim(self) -> None:
        if self.held > self.limit:
            self.older, self.held = dict(self), 0
            self.clear()


@functools.lru_cache(maxsize=1)
def _other_numbers() -> frozenset[str]:
    """Numbers that are no decimal digits; the simple pattern would take them for letters."""
    return frozenset(c for c in map(chr, range(0x110000))
                     if unicodedata.category(c) in ("Nl", "No"))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`df` with `ids` array<int>, the token ids of the whole text (null: empty)."""
    path = path or model_path()

    def run(values: pa.Array) -> pa.Array:
        coder = encoder(path)
        return pa.array([coder.encode(x or "") for x in values.to_pylist()],
                        pa.list_(pa.int32()))

    return common.put(df, "ids", common.column(run, "array<int>")(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """`df` with `decoded`, the text of the ids (null: empty)."""
    path = path or model_path()

    def run(values: pa.Array) -> pa.Array:
        coder = encoder(path)
        return pa.array([coder.decode(x or []) for x in values.to_pylist()], pa.string())

    return common.put(df, "decoded", common.column(run, "string")(F.col(ids)))


def digests(df: DataFrame, text: str = "text", path: str | None = None,
            with_ids: bool = False) -> DataFrame:
    """`df` with n_tokens, the SHA-256 of the ids and of the decoded text, and maybe `ids`.

    One pass of the same encoder: ids and decoded text of a document exist one at a time. A
    null or empty text has no ids. Repeated rows give repeated results; columns named like the
    results are replaced.
    """
    path = path or model_path()
    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    if with_ids:
        fields["ids"] = "array<int>"

    def run(values: pa.Array) -> pa.Array:
        coder = encoder(path)
        counts, ids, decoded, lists = [], [], [], []
        for scalar in values:
            spaced, text = coder.spaced(scalar.as_py() or "")
            counts.append(spaced.count(" ") + 1 if spaced else 0)
            ids.append(_sha(spaced))
            decoded.append(_sha(text))
            if with_ids:
                lists.append(pa.array(np.fromstring(spaced, np.int32, sep=" ")))
        columns = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                   pa.array(decoded, pa.string())]
        if with_ids:
            ends = [0, *itertools.accumulate(counts)]
            columns.append(pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()),
                pa.concat_arrays(lists) if lists else pa.array([], pa.int32())))
        return pa.StructArray.from_arrays(columns, list(fields))

    out = df.withColumn("__bpe", common.column(
        run, ", ".join(f"{k} {v}" for k, v in fields.items()))(F.col(text)))
    return out.withColumns({f: F.col(f"__bpe.{f}") for f in fields}).drop("__bpe")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
