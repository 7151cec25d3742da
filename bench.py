"""Seconds per headline query; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The input of the observation queries is what production has: landed record files for the parser,
stored Silver for the others. Both are written first, untimed, in as many files as there are
cores. Every query is run once untimed, at the timed scale, as the first run also compiles its
code; then it is timed writing its whole result to Spark's no-op sink (streaming queries also
write their own tables). `stored_daily_route` is the daily table from a stored, bucketed stop
table.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import functions as F

from stoptide import catalog, session
from stoptide import schemas as S
from stoptide.operators.latest import last_observation
from stoptide.plans import gold, silver
from stoptide.sources import files, frames, sinks

# Headline queries: the Gold tables, the change filter, the streaming deduplication.
HEADLINE = [
    "last_obs", "delay_delta", "route_propagate", "trip_endpoints", "daily_route",
    "segment_stats", "station_pair_stats", "join_station_coords", "join_plan_change",
    "change_filter_batch", "stream_dedup", "silver_parse",
]


def stored_queries(spark, sf_dir: str, parts: int) -> dict:
    """The queries on observations, from landed records and from stored Silver."""
    landed, stored = (session.scratch_dir(spark, n) for n in ("landed", "silver"))
    line = F.to_json(F.struct(*S.RECORD_COLUMNS), {"ignoreNullFields": "false"})
    frames.records(frames.payloads(spark, sf_dir)).repartition(parts).select(
        line.alias("value")).write.option("compression", "gzip").text(landed)
    frames.observations(spark, sf_dir).repartition(parts).write.parquet(stored)
    stations = frames.stations(spark, sf_dir)

    def rows():
        return spark.read.parquet(stored)

    def stops():
        return gold.stop_table(rows())

    return {
        "silver_parse": lambda: silver.silver(files.landed_records(spark, landed)),
        "last_obs": lambda: last_observation(rows()),
        "delay_delta": stops,
        "route_propagate": lambda: stops().select("stop_id", "full_route", "origin"),
        "trip_endpoints": lambda: gold.trip_table(stops()),
        "daily_route": lambda: gold.daily_route_table(gold.trip_table(stops())),
        "segment_stats": lambda: gold.segment_table(stops()),
        "station_pair_stats": lambda: gold.station_pair_table(stops()),
        "join_station_coords": lambda: gold.segment_table(stops(), stations),
    }


def stored_daily_route(spark, sf_dir: str) -> float:
    """Seconds from the stored stop table to the daily table; writing it is not counted."""
    database = f"bench_{uuid.uuid4().hex}"
    sinks.create_database(spark, database)
    table = f"{database}.stop"
    gold.save_stops(gold.stop_table(frames.observations(spark, sf_dir)), table, buckets=8)
    for _ in range(2):
        started = time.perf_counter()
        gold.daily_route_table(gold.trip_table(spark.table(table))) \
            .write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = session.build(f"local[{cpus}]", shuffle_partitions=cpus, **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: lambda name=name: catalog.queries()[name](spark, sf_dir) for name in names}
    queries |= stored_queries(spark, sf_dir, cpus)

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name]().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    if not sys.argv[1:]:
        seconds["stored_daily_route"] = round(stored_daily_route(spark, sf_dir), 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds[name] for name in names), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale) if _number(scale) else scale,
        "cpus": cpus, "shuffle_partitions": cpus,
    }))
    spark.stop()


def _number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


if __name__ == "__main__":
    main()
