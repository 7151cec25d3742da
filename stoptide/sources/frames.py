"""The driver's tables as rail frames.

One row of `lineitem`, joined to its order, is one observation of one stop; rows that share
order and line number are repeated observations of the same stop. `events` are the poll
cycles, `supplier` the stations. The mapping is made of column arithmetic only, so all work
grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import path_array
from ..session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _stop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return from_lines(lines, orders)


def from_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The mapping itself; also used on a streaming `lines`."""
    e = F.expr
    # made below the join, so that its shuffle carries one number for what it is made of
    delayed = lines.withColumn("arrival_delay", e(
        "CASE WHEN l_returnflag = 'A' AND l_partkey % 3 = 0 THEN NULL "
        "ELSE cast(l_quantity AS int) - 10 END"))
    joined = delayed.join(orders, F.col("l_orderkey") == F.col("o_orderkey")) \
        .withColumn("start_at", F.col("o_orderdate").cast("timestamp"))
    arrival_delay = F.col("arrival_delay")
    departure_delay = e("CASE WHEN l_partkey % 7 = 0 THEN NULL "
                        "ELSE cast(l_partkey % 41 AS int) - 5 END")
    planned_arrival = e("timestamp_seconds(unix_timestamp(start_at) + 3600 * l_linenumber)")
    planned_departure = e(
        "timestamp_seconds(unix_timestamp(start_at) + 3600 * l_linenumber + 300)")
    category = e("CASE l_orderkey % 8 WHEN 0 THEN 'ICE' WHEN 1 THEN 'IC' WHEN 2 THEN 'EC' "
                 "WHEN 3 THEN 'FLX' WHEN 4 THEN 'RE' WHEN 5 THEN 'S' WHEN 6 THEN 'NJ' END")
    return joined.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        "start_at",
        F.col("l_linenumber").cast("int").alias("stop_index"),
        e("concat(l_orderkey, '-', date_format(start_at, 'yyMMddHHmm'), '-', l_linenumber)")
        .alias("stop_id"),
        F.col("l_suppkey").cast("long").alias("station_eva"),
        e("concat('S', l_suppkey)").alias("station_name"),
        category.alias("train_category"),
        e("cast(l_orderkey % 97 AS string)").alias("train_number"),
        e("cast(l_orderkey % 13 AS string)").alias("train_operator"),
        e("CASE l_orderkey % 8 WHEN 4 THEN 'N' WHEN 5 THEN 'S' WHEN 3 THEN NULL "
          "WHEN 7 THEN NULL ELSE 'F' END").alias("train_filter"),
        e("CASE WHEN l_orderkey % 4 <> 1 THEN concat('B', l_orderkey % 97) END").alias("brand"),
        planned_arrival.alias("planned_arrival_at"),
        planned_departure.alias("planned_departure_at"),
        arrival_delay.alias("arrival_delay_minutes"),
        departure_delay.alias("departure_delay_minutes"),
        F.timestamp_seconds(F.unix_timestamp(planned_arrival) + arrival_delay * 60)
        .alias("changed_arrival_at"),
        F.timestamp_seconds(F.unix_timestamp(planned_departure) + departure_delay * 60)
        .alias("changed_departure_at"),
        e("cast(l_suppkey % 12 + 1 AS string)").alias("planned_arrival_platform"),
        e("CASE WHEN l_partkey % 3 = 0 THEN cast(l_partkey % 12 + 1 AS string) "
          "WHEN l_partkey % 5 = 0 THEN '' END").alias("changed_arrival_platform"),
        e("CASE WHEN l_partkey % 19 = 0 THEN 'c' WHEN l_partkey % 17 = 0 THEN 'a' END")
        .alias("arrival_status"),
        e("CASE WHEN l_partkey % 38 = 0 THEN 'c' WHEN l_partkey % 23 = 0 THEN 'a' END")
        .alias("departure_status"),
        e("l_partkey % 19 = 0").alias("is_cancelled"),
        e("timestamp_seconds(unix_timestamp(cast(l_shipdate AS timestamp)) + l_partkey * 60 "
          "+ l_suppkey)").alias("observed_at"),
        e("CASE WHEN l_linenumber = 1 THEN NULL WHEN l_partkey % 5 = 0 THEN '' "
          "ELSE concat('S', l_suppkey % 9, '||S', l_partkey % 6) END").alias("planned_path_from"),
        e("CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 7 = 0 THEN '' "
          "ELSE concat('S', l_suppkey % 11, '|S', l_partkey % 13) END").alias("planned_path_to"),
        e("CASE WHEN l_partkey % 8 = 0 THEN '' WHEN l_partkey % 4 = 0 "
          "THEN concat('S', l_partkey % 5) END").alias("changed_path_from"),
        e("CASE WHEN l_partkey % 10 = 0 THEN concat('S', l_suppkey % 3, '| ') END")
        .alias("changed_path_to"),
        # Unique per partition: order, line and time of the observation, side by side.
        e("cast((l_orderkey div 10000000) * 2 + l_orderkey % 2 AS int)")
        .alias("kafka_partition"),
        e("(l_orderkey % 10000000) * 100000000000 + l_linenumber * 10000000000 "
          "+ unix_timestamp(cast(l_shipdate AS timestamp)) + l_partkey * 60 + l_suppkey")
        .alias("kafka_offset"),
        e("CASE WHEN l_partkey % 2 = 0 THEN array(array(l_returnflag, l_linestatus, "
          "cast(NULL AS string))) ELSE cast(array() AS array<array<string>>) END")
        .alias("messages"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed observations, as Silver holds them, with the raw path texts next to the arrays."""
    return as_silver(_stop_rows(spark, sf_dir))


def as_silver(rows: DataFrame) -> DataFrame:
    return (
        rows
        .withColumn("path_from",
                    path_array(F.col("changed_path_from"), F.col("planned_path_from")))
        .withColumn("path_to", path_array(F.col("changed_path_to"), F.col("planned_path_to")))
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same observations as the producer sends them: 28 fields, times as local texts.

    `kafka_partition` and `kafka_offset` are kept for the record around the payload.
    """
    return as_payload(_stop_rows(spark, sf_dir))


def as_payload(rows: DataFrame) -> DataFrame:
    def local(name: str):
        return F.date_format(name, "yyMMddHHmm")

    return rows.select(
        "stop_id", "station_eva", "station_name", "trip_id",
        local("start_at").alias("start_datetime"), "stop_index",
        "train_category", "train_number", "train_operator", "train_filter",
        local("planned_arrival_at").alias("planned_arrival"),
        local("changed_arrival_at").alias("changed_arrival"),
        local("planned_departure_at").alias("planned_departure"),
        local("changed_departure_at").alias("changed_departure"),
        "planned_arrival_platform",
        F.col("planned_arrival_platform").alias("planned_departure_platform"),
        "changed_arrival_platform",
        F.lit(None).cast("string").alias("changed_departure_platform"),
        "planned_path_from", "planned_path_to", "changed_path_from", "changed_path_to",
        "arrival_status", "departure_status",
        F.when(F.col("is_cancelled"), local("planned_arrival_at")).alias("cancelled_at"),
        "brand", "messages",
        F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("observed_at"),
        "kafka_partition", "kafka_offset",
    )


def records(payload: DataFrame, topic: str = "stops") -> DataFrame:
    """The payloads wrapped as Kafka records."""
    fields = [c for c in payload.columns if not c.startswith("kafka_")]
    return payload.select(
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        (F.unix_timestamp(F.try_to_timestamp("observed_at")) * 1000).alias("timestamp"),
        F.col("stop_id").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def poll_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the poll cycles: key, day number of the poll, content."""
    return as_polls(table(spark, sf_dir, "events"))


def as_polls(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("key"),
        F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("cycle"),
        F.col("event_id").alias("position"),
        F.col("event_type").alias("content"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station dimension; every seventh station lacks coordinates."""
    key = F.col("s_suppkey")
    known = key % 7 != 3
    return table(spark, sf_dir, "supplier").select(
        key.cast("long").alias("station_eva"),
        F.concat(F.lit("S"), key).alias("station_name"),
        F.col("s_name").alias("stada_name"),
        F.when(known, F.lit(47.0) + (key % 80) / 10).alias("latitude"),
        F.when(known, F.lit(6.0) + (key % 90) / 10).alias("longitude"),
        F.when(known, F.lit("stada")).otherwise(F.lit("missing")).alias("coordinate_source"),
        (key % 7 + 1).cast("int").alias("category"),
        F.concat(F.lit("L"), F.col("s_nationkey")).alias("federal_state"),
        (key % 50).cast("long").alias("route_calls"),
    )
