"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    common,
    decontaminate,
    extract,
    langid,
    negatives,
    packing,
    pivots,
    prefixes,
    secrets,
    simhash,
    suffixes,
    urls,
    warc,
)
from .oracle import ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return common.small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of benchmark items."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, _table(spark, sf_dir, "benchmark")).drop("text")
    scan = F.col("scan")
    return found.select(
        "doc_id", scan["n_words"].alias("n_words"), scan["n_hit"].alias("n_hit"),
        F.size(scan["items"]).cast("long").alias("n_items"),
        decontaminate.items_digest(scan).alias("items_sha256"),
        decontaminate.contaminated(scan).alias("contaminated"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that earlier documents have."""
    found = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of documents by fingerprints."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials in documents; a document is a repository, its source the owner."""
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs)
    rows = docs.select("doc_id", secrets.row_key(docs, "text", "doc_id", "source").alias("__row"))
    out = rows.join(found, "__row")

    def count(kind: int):
        return F.size(F.filter("base", lambda x: x["k"] == kind)).cast("long")

    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.label(F.col("base")), 256).alias("base_sha256"),
        secrets.label(F.col("found")).alias("spans"), "n_live", "n_examples")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents, and what they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages).select(
        "page_id", "url", F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of documents, learnt from those that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn(docs.where(~langid.held_out()))
    out = langid.predict(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urls.judge(_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of embeddings."""
    return pivots.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor among the embeddings; some rows have the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), label)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 1,024 tokens."""
    return packing.pack(packing.pieces(_table(spark, sf_dir, "documents")))


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations."""
    turns = prefixes.ordered(_table(spark, sf_dir, "conversations"))
    return prefixes.trie(prefixes.rebuild(turns)).drop("a", "b")


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_warc": op2_warc,
    "op3_suffixes": op3_suffixes,
    "op4_simhash": op4_simhash,
    "op5_secrets": op5_secrets,
    "op6_bpe": op6_bpe,
    "op7_extract": op7_extract,
    "op8_langid": op8_langid,
    "op9_urls": op9_urls,
    "op10_pivots": op10_pivots,
    "op11_negatives": op11_negatives,
    "op12_packing": op12_packing,
    "op13_prefixes": op13_prefixes,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
