"""Bronze records to typed observations. Works on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import (
    cancel_flag,
    computed_once,
    db_timestamp,
    delay_minutes,
    iso_timestamp,
    path_array,
)
from ..session import require_utc
from ..sources.files import record_fault

RAW_COLUMNS = [
    "planned_arrival", "changed_arrival", "planned_departure", "changed_departure",
    "start_datetime", "planned_path_from", "planned_path_to",
    "changed_path_from", "changed_path_to",
]
LINEAGE = ["_source_file", "_bronze_ingested_at"]


def flatten(records: DataFrame, payload: T.StructType = S.PAYLOAD) -> DataFrame:
    """The record's origin next to the fields of its JSON payload."""
    lineage = [c for c in LINEAGE if c in records.columns]
    return records.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        *lineage,
        computed_once(F.from_json("value", payload)).alias("obs"),
    ).select("kafka_partition", "kafka_offset", *lineage, "obs.*")


def typed(flat: DataFrame) -> DataFrame:
    """Instants, delays, cancellation flag and route arrays instead of the raw texts."""
    require_utc(flat.sparkSession)
    times = flat.withColumns({
        "observed_at": iso_timestamp(F.col("observed_at")),
        "start_at": db_timestamp(F.col("start_datetime")),
        "planned_arrival_at": db_timestamp(F.col("planned_arrival")),
        "changed_arrival_at": db_timestamp(F.col("changed_arrival")),
        "planned_departure_at": db_timestamp(F.col("planned_departure")),
        "changed_departure_at": db_timestamp(F.col("changed_departure")),
        "cancelled_at": db_timestamp(F.col("cancelled_at")),
    })
    return times.withColumns({
        "arrival_delay_minutes": delay_minutes(
            F.col("planned_arrival_at"), F.col("changed_arrival_at")),
        "departure_delay_minutes": delay_minutes(
            F.col("planned_departure_at"), F.col("changed_departure_at")),
        "is_cancelled": cancel_flag(F.col("arrival_status"), F.col("departure_status")),
        "path_from": path_array(F.col("changed_path_from"), F.col("planned_path_from")),
        "path_to": path_array(F.col("changed_path_to"), F.col("planned_path_to")),
    }).drop(*RAW_COLUMNS)


def silver(records: DataFrame, payload: T.StructType = S.PAYLOAD) -> DataFrame:
    """Flatten and type; rows without a stop id or an observation time are left out.

    Fields that `payload` has beyond the known ones are passed on as they are.
    """
    return typed(flatten(records, payload)).filter(
        "stop_id IS NOT NULL AND observed_at IS NOT NULL")


def silver_quarantine(records: DataFrame) -> DataFrame:
    """The records that do not become observations, unparsed, each with the reason.

    Faulty lines, payloads without a stop id, and payloads without a readable time: what is
    here and what `silver` makes of the sound records add up to Bronze.
    """
    obs = computed_once(F.from_json("value", S.PAYLOAD))
    tested = records.select("*", record_fault().alias("_fault"), obs.alias("_obs"))
    reason = (
        F.when(F.col("_fault") & F.col("_corrupt_record").isNotNull(), "not JSON")
        .when(F.col("_fault"), "not a record")
        .when(F.col("_obs.stop_id").isNull(), "no stop id")
        .when(iso_timestamp(F.col("_obs.observed_at")).isNull(), "no observation time"))
    return tested.withColumn("reason", reason).filter("reason IS NOT NULL").drop("_fault", "_obs")
