"""Timetable documents (XML) to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import computed_once

# The XML reader takes any root, and gives the same empty struct for an HTML page, for junk
# and for an empty timetable, so the root is tested on the text.
_ROOT = r"^\x{FEFF}?\s*(<\?xml[^>]*>)?\s*(<!--[\s\S]*?-->\s*)*<timetable[\s/>]"
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "false",
}


def stored_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document."""
    return _whole_files(spark.read, path)


def stored_document_stream(spark: SparkSession, path: str,
                           max_files: int | None = None) -> DataFrame:
    """The same as a stream that takes every document once."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _whole_files(reader, path)


def _whole_files(reader, path: str) -> DataFrame:
    return reader.format("text").option("wholetext", "true").load(path).select(
        F.col("value").alias("document"), F.col("_metadata.file_path").alias("_source_file"))


def is_timetable(document: Column) -> Column:
    """False for anything whose root is not `timetable`, so an error page is not read as
    "no changes"."""
    return F.coalesce(document.rlike(_ROOT), F.lit(False))


def parsed(documents: DataFrame, schema: str, column: str = "document") -> DataFrame:
    """The document as `doc`, and `failed`: another root, or XML that does not parse.

    The document's text and its other columns stay.
    """
    root = is_timetable(F.col(column))
    doc = F.from_xml(F.when(root, F.col(column)), schema, _OPTIONS)
    return documents.select("*", computed_once(doc).alias("doc")).withColumn(
        "failed", ~root | F.col("doc._corrupt_record").isNotNull())


def split_failed(documents: DataFrame, schema: str = S.CHANGE_DOCUMENT,
                 column: str = "document") -> tuple[DataFrame, DataFrame]:
    """(timetables, everything that is none), unparsed."""
    tested = parsed(documents, schema, column).drop("doc")
    return tested.filter("NOT failed").drop("failed"), tested.filter("failed").drop("failed")


def _stops(documents: DataFrame, column: str, schema: str) -> DataFrame:
    """One row per <s> with its position; the other columns of the document stay with it."""
    others = [c for c in documents.columns if c != column]
    return parsed(documents, schema, column).filter("NOT failed") \
        .select(*others, F.posexplode("doc.s").alias("position", "s"))


def plan_stops(documents: DataFrame, column: str = "document") -> DataFrame:
    """Train identity and planned values. The documents' other columns are carried along."""
    others = [c for c in documents.columns if c != column]
    return _stops(documents, column, S.PLAN_DOCUMENT).select(
        *others,
        F.col("s._id").alias("stop_id"),
        F.col("s.tl._c").alias("train_category"),
        F.col("s.tl._n").alias("train_number"),
        F.col("s.tl._o").alias("train_operator"),
        F.col("s.tl._f").alias("train_filter"),
        F.col("s.ar._pt").alias("planned_arrival"),
        F.col("s.dp._pt").alias("planned_departure"),
        F.col("s.ar._pp").alias("planned_arrival_platform"),
        F.col("s.dp._pp").alias("planned_departure_platform"),
        F.col("s.ar._ppth").alias("planned_path_from"),
        F.col("s.dp._ppth").alias("planned_path_to"),
    )


def _first_filled(arrival: str, departure: str) -> Column:
    return F.coalesce(F.nullif(F.col(arrival), F.lit("")), F.col(departure))


def _messages() -> Column:
    """(type, code, category) of every message, in the order arrival, departure, stop."""
    groups = [F.coalesce(F.col(c), F.array().cast("array<struct<_t:string,_c:string,_cat:string>>"))
              for c in ("s.ar.m", "s.dp.m", "s.m")]
    return F.transform(F.concat(*groups), lambda m: F.array(m["_t"], m["_c"], m["_cat"]))


def change_stops(documents: DataFrame, column: str = "document") -> DataFrame:
    """Changed values, status and messages of every stop of a change document.

    `position` is the stop's place in its document.
    """
    others = [c for c in documents.columns if c != column]
    return _stops(documents, column, S.CHANGE_DOCUMENT).select(
        *others, "position",
        F.col("s._id").alias("stop_id"),
        F.col("s.ar._ct").alias("changed_arrival"),
        F.col("s.dp._ct").alias("changed_departure"),
        F.col("s.ar._cp").alias("changed_arrival_platform"),
        F.col("s.dp._cp").alias("changed_departure_platform"),
        F.col("s.ar._cpth").alias("changed_path_from"),
        F.col("s.dp._cpth").alias("changed_path_to"),
        F.col("s.ar._cs").alias("arrival_status"),
        F.col("s.dp._cs").alias("departure_status"),
        _first_filled("s.ar._clt", "s.dp._clt").alias("cancelled_at"),
        _first_filled("s.ar._fb", "s.dp._fb").alias("brand"),
        _messages().alias("messages"),
    )
