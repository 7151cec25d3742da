"""Registration, and the pipeline's stages against brute force."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from stoptide.llm import queries
from tests.compare import connect, differences
from tests.llm.test_decontaminate import slow as slow_scan
from tests.llm.test_secrets import slow as slow_secrets
from tests.llm.test_simhash import slow_components, slow_print

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(driver.queries())
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    found, _ = differences(spark, connect(SF), SF, queries.queries()[name],
                           queries.oracle_sql()[name])
    assert not found, "\n".join(found)


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"]: r for r in docs.collect()}
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    items = list(zip(map(str, bench["item_id"]), bench["text"], strict=True))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        rows = {r["doc_id"]: r for r in docs.collect()}
        docs = spark.createDataFrame(list(rows.values()), docs.schema)
        if name == "language":
            want = {i for i, r in kept.items() if any(c.isalpha() for c in r["text"] or "")}
        elif name == "near_duplicates":
            label = slow_components({i: slow_print(r["text"]) for i, r in kept.items()})
            want = {i for i in kept if label[i] == i}
        elif name == "decontamination":
            want = set()
            for i, r in kept.items():
                words, hit, _ = slow_scan(r["text"], items)
                if not (hit and 20 * hit >= words):
                    want.add(i)
        elif name == "secrets":
            want = set(kept)
            for i, r in rows.items():
                assert slow_secrets(r["text"]) == ""
                assert r["n_chars"] == len(r["text"])
                if not slow_secrets(kept[i]["text"]):
                    assert r["text"] == kept[i]["text"]
        else:
            want = set(kept)
            assert all(len(r["ids"]) == r["n_tokens"] for r in rows.values())
        assert set(rows) == want, name
        if name != "tokens":
            assert docs.columns == corpus_pipeline.COLUMNS
        kept = rows


def test_languages_that_were_never_learnt_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    texts = ["Привет, это документ на русском языке о погоде.", "这是一个关于天气的中文文档。",
             "هذا نص باللغة العربية عن الطقس", "The weather of today and the news."]
    rows = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(texts)]
    found = corpus_pipeline.STAGES[0][1](
        spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF)
    assert {r["doc_id"] for r in found.where("doc_id < 0").collect()} == {-4}
    labelled = docs.where("lang IS NOT NULL AND text RLIKE '[A-Za-z]'")
    assert labelled.join(found, "doc_id", "left_anti").count() == 0


def test_run_and_odd_rows(spark, tmp_path):
    base = " ".join(f"word{i}" for i in range(50))
    rows = [(1, base, "en", "s", 1), (2, base, "en", "s", 1), (2, base, "en", "s", 1),
            (None, "another text", None, None, None), (None, "a third one", None, None, None),
            (4, None, "en", None, None), (5, "", "en", "s", 0), (6, "123", "en", "s", 3),
            (7, "token=0123456789abcdef0123 is here", "en", "s", 1)]
    kind = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("1", None)], "item_id STRING, text STRING").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == [1, 7, None, None]
    spark.createDataFrame([], kind).write.mode("overwrite").parquet(
        f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
