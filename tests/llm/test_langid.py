from __future__ import annotations

import zlib

from stoptide.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = langid.learn(df.where(~langid.held_out()))
    out = langid.predict(df, profiles).withColumn("h", langid.held_out()).where("h").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in out)
    known = [r for r in out if r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in known) >= 0.99 * len(known)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_ranks_and_distance_by_hand():
    model = langid.Model({"a": [ord("x"), ord("y")], "b": [ord("y"), ord("x")]})
    # n-grams of the text: x twice, then y and the longer ones; two places are compared
    owner, gram, rank = langid.ranked(*langid.grams(["x x y"]), 2)
    assert owner.tolist() == [0, 0] and rank.tolist() == [0, 1]
    assert gram[0] == ord("x")
    (name,), (score,) = model.judge(["x x y"])
    assert name == "a" and score == 1 - 2 / 4       # x in place, the second gram unknown


def test_counts_against_brute_force():
    text = "Ab, ab2b"
    flat = " ab ab b "
    want = {}
    for n in langid.LENGTHS:
        for i in range(len(flat) - n + 1):
            if flat[i:i + n] != " ":
                want[flat[i:i + n]] = want.get(flat[i:i + n], 0) + 1
    owner, gram, count = langid.grams([None, text, ""])
    assert set(owner.tolist()) == {1}
    got = {}
    for g, c in zip(gram.tolist(), count.tolist(), strict=True):
        s = ""
        while g:
            s, g = chr(g & 0xFFFF) + s, g >> 16
        got[s] = c
    assert got == want


def test_texts_without_letters_and_empty_tables(spark, docs):
    learnt = docs([(i, t, n, "s") for i, (t, n) in enumerate(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "fr"),
         ("text", None)])])
    profiles = langid.learn(learnt)
    assert sorted(profiles) == ["de", "en"]
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "12 - 😀", "en", "s"),
            (4, "und die", "en", "s"), (4, "und die", "en", "s"), (None, "the dog " * 9000, None, None)]
    out = langid.predict(docs(rows, "score"), profiles).collect()
    assert len(out) == len(rows)
    assert [(r["doc_id"], r["lang_pred"]) for r in out] == [
        (1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "en")]
    assert langid.predict(docs(rows).limit(0), profiles).count() == 0
    assert langid.learn(learnt.limit(0)) == {}
    assert {r["lang_pred"] for r in langid.predict(docs(rows), {}).collect()} == {"und"}


def test_repeated_texts_count_once(spark, docs):
    """Copies neither fill the sample nor keep a language of few texts out of it."""
    texts = [f"the cat number {i} and the dog" for i in range(40)]
    few = [f"{c}und die Katze{c}" for c in "xyz"]
    once = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(99, t, "de", "s") for t in few]
    many = once + [(100 + i, texts[i // 500], "en", "s") for i in range(2000)] \
        + [(5000 + i, t, "de", "s") for t in few for i in range(700)]
    for sample in (3, 10, 1000):
        want = langid.learn(docs(once), sample=sample)
        assert "de" in want
        assert langid.learn(docs(many), sample=sample) == want


def test_equal_sums_take_the_first_name():
    model = langid.Model({"b": [ord("x")], "a": [ord("x")]})
    assert model.judge(["x"])[0] == ["a"]
