"""Files: landed records, timetable tables, station master data, geometry, saved tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S


def with_lineage(records: DataFrame) -> DataFrame:
    """Which file each record came from, and when it was stored."""
    return (
        records
        .withColumn("_source_file", F.col("_metadata.file_path"))
        .withColumn("_bronze_ingested_at", F.current_timestamp())
    )


def _permissive(reader):
    return (
        reader.format("json").schema(S.RECORD)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", "true")
    )


def landed_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines as a batch; gzip is recognised by the file extension."""
    return with_lineage(_permissive(spark.read).load(path))


def landed_stream(spark: SparkSession, path: str,
                  max_files: int | None = None) -> DataFrame:
    """The same as a stream that takes every file once."""
    reader = _permissive(spark.readStream)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return with_lineage(reader.load(path))


def record_fault() -> Column:
    """A line that did not parse, or valid JSON of another shape.

    JSON of another shape comes in as a row of NULLs without a corrupt record, so the
    required columns are tested as well.
    """
    fault = F.col("_corrupt_record").isNotNull()
    for name in S.RECORD_REQUIRED:
        fault = fault | F.col(name).isNull()
    return fault


def gtfs_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One unpacked timetable CSV table, all texts, columns matched by the header.

    A byte-order mark at the start of the header would become part of the first column's
    name, so columns are taken in declared order only where the header agrees without it.
    """
    schema = S.GTFS[table]
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = {c.lstrip("﻿").strip(): c for c in raw.columns}
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{table}: the header lacks {missing}")
    return raw.select(*[F.col(f"`{names[f.name]}`").alias(f.name) for f in schema])


def station_master(spark: SparkSession, path: str) -> DataFrame:
    """One row per station number (EVA) of the nested station file."""
    stations = (
        spark.read.schema(S.STATION_MASTER).option("multiLine", True).json(path)
        .select(F.explode("result").alias("station"))
        .select("station.*")
    )
    return explode_eva_numbers(stations)


def explode_eva_numbers(stations: DataFrame) -> DataFrame:
    coordinates = F.col("entry.geographicCoordinates.coordinates")
    return (
        stations
        .select(
            F.col("number").alias("station_number"),
            F.col("name").alias("stada_name"),
            "category",
            F.col("federalState").alias("federal_state"),
            F.explode("evaNumbers").alias("entry"),
        )
        .select(
            F.col("entry.number").alias("eva"),
            F.col("entry.isMain").alias("is_main"),
            "station_number", "stada_name", "category", "federal_state",
            F.get(coordinates, F.lit(0)).alias("longitude"),
            F.get(coordinates, F.lit(1)).alias("latitude"),
        )
    )


def station_dimension(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.STATION).json(path)


def segment_geometry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.SEGMENT_GEOMETRY).json(path)


def stored_order(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of `sinks.write_ordered` with their place, from 1.

    A row knows its place in its file; the rows of the files before it are added, a number per
    file. Nothing is sorted again.
    """
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"))
    order = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    return rows.join(before, "_file").withColumn(
        position, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")
