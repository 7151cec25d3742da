from __future__ import annotations

import hashlib
import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stoptide.llm import bpe


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path(bpe.MODEL))
    found.no_truncation()
    found.no_padding()
    return found


TEXTS = [None, "", " ", "Hello  wörld's 1234", "ΟΔΟΣ Σ", "İstanbul ß", "é  x y",
         "a<|endoftext|>b<|startoftext|>", "don't WE'LL", "x" * 5000, "\x1c\x1d\x85 a",
         "½ xⅧ²y ٣ _a__b_ ①", "日本語 テキスト 😀👩‍👩‍👧", "क्षि १२", "\u0000​"]


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_encodes_and_decodes_as_the_library(library, text):
    coder = bpe.encoder(bpe.model_path())
    ids = library.encode(text, add_special_tokens=False).ids
    assert coder.encode(text) == ids
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


_LIBRARY = Tokenizer.from_file(public_tokenizers.path(bpe.MODEL))


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(min_codepoint=1, max_codepoint=0x2FF), max_size=60))
def test_any_latin_text(text):
    coder = bpe.encoder(bpe.model_path())
    assert coder.encode(text) == _LIBRARY.encode(text, add_special_tokens=False).ids


def test_merges_by_rank_and_skips_stale_entries():
    coder = bpe.encoder(bpe.model_path())

    order = {tuple(m): i for i, m in enumerate(
        json.load(open(bpe.model_path(), encoding="utf-8"))["model"]["merges"])}

    def slow(word):
        symbols = [coder.bytes[b] for b in word.encode()]
        symbols[-1] += coder.suffix
        while True:
            ranks = [order.get(p, 1 << 30) for p in zip(symbols, symbols[1:])]
            if not ranks or min(ranks) == 1 << 30:
                return [coder.vocab[s] for s in symbols]
            k = ranks.index(min(ranks))
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]

    for word in ("internationalization", "aaaaaaaa", "banana" * 9, "zzz", "théâtre"):
        assert coder.merge(word) == slow(word)


def test_digests_of_rows(spark, docs, library):
    df = docs([(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(0, None, None, None)],
              "n_tokens")
    rows = bpe.digests(df, with_ids=True).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids"]) == (len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(df.limit(0)).count() == 0


def test_round_trip_of_columns(docs):
    df = bpe.decode(bpe.encode(docs([(1, "lower case", "en", "s"), (2, None, "en", "s")])))
    assert [r["decoded"] for r in df.orderBy("doc_id").collect()] == ["lower</w> case</w>", ""]


def test_words_are_remembered_within_bounds():
    made = []

    def make(word):
        made.append(word)
        return word, word

    words = bpe._Words(make, limit=3 * bpe._ENTRY_BYTES)
    for text in (["a", "b", "a"], ["c", "d"], ["a", "e"], ["f", "g", "h"], ["i"]):
        assert [words[w] for w in text] == [(w, w) for w in text]
        words.trim()
        assert len(words) <= 4 and len(words.older) <= 7
    assert made[:5] == ["a", "b", "c", "d", "e"]      # a was in the older generation


def test_few_and_many_places_agree(monkeypatch):
    coder = bpe.encoder(bpe.model_path())
    words = ["overwhelmingly", "naïveté", "x" * 300, "zzzz", "a", "électroencéphalographie"]
    want = [coder.merge(w) for w in words]
    monkeypatch.setattr(bpe, "_FEW", 1)
    assert [coder.merge(w) for w in words] == want
