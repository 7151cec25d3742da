"""Gold tables: stop, trip, daily route, segment and station pair.

Shuffles. The stop table needs one on the stop id (at most one row per key and task moves)
and one on (trip_id, start_at). The trip table, the segment neighbours and the pairs use that
second partitioning and its sort order again: inside one job they add no shuffle up to their
own group by, and neither do they when the stop table is stored bucketed (`save_stops`).
Percentiles (as counts per minute of delay), counts and averages are summarised before the
last shuffle.

A trip's group is bounded: after the collapse it holds one row per stop index, and
`checks.check_trip_length` refuses tables in which some trip has more than any train calls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import (
    brand_fallback,
    is_long_distance,
    percentile_array,
    planned_minutes,
    route_build,
    route_destination,
    route_origin,
    service_date,
    share,
    split_stop_id,
    usable_length,
)
from ..operators.latest import last_observation
from ..session import remove_scratch, scratch_dir, spent_shuffles
from ..sources.sinks import DENSE, create_database, overwrite_table
from . import checks, geometry

TRIP = ["trip_id", "start_at"]
_STOP_ORDER = ["stop_index", "stop_id"]


def _trip_order() -> Window:
    return Window.partitionBy(*TRIP).orderBy(*_STOP_ORDER)


def _whole_trip() -> Window:
    return _trip_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _latest_delay() -> Column:
    return F.coalesce("departure_delay_minutes", "arrival_delay_minutes")


def _trip_key() -> Column:
    """The trip id; without one, that in the stop id, else the stop is a trip of its own.

    All rows without a trip id would otherwise meet in one group of any size.
    """
    parsed, _, _ = split_stop_id(F.col("stop_id"))
    return F.coalesce("trip_id", parsed, "stop_id")


def _told_by_stop_id(observations: DataFrame) -> DataFrame:
    """The trip id only where the stop id does not tell it: `_trip_key` finds it again.

    A shuffle need not carry it twice.
    """
    parsed, _, _ = split_stop_id(F.col("stop_id"))
    return observations.withColumn("trip_id", F.nullif(F.col("trip_id"), parsed))


def stop_rows(last: DataFrame, local_date: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Last observations as stops, with the route that each tells by itself (`route`).

    `keep` names further columns to carry.
    """
    return last.select(
        *keep,
        "stop_id", _trip_key().alias("trip_id"), "start_at", "train_category", "train_number", "train_operator",
        brand_fallback(F.col("brand"), F.col("train_operator")).alias("train_brand"),
        "station_eva", "station_name", "stop_index",
        route_build(F.col("path_from"), F.col("station_name"), F.col("path_to"))
        .alias("route"),
        "planned_arrival_at", "changed_arrival_at",
        "planned_departure_at", "changed_departure_at",
        "arrival_delay_minutes", "departure_delay_minutes", "is_cancelled",
        service_date(F.col("planned_departure_at"), F.col("planned_arrival_at"), local_date)
        .alias("service_date"),
        "observed_at",
        is_long_distance(F.col("train_category")).alias("is_long_distance"),
    )


def along_trips(rows: DataFrame, partitions: int = 0, own: str | None = None) -> DataFrame:
    """Stops (`stop_rows`) with what their trip tells them: the route, the delay before.

    A stop without a usable route takes the longest one of its trip; equally long routes are
    told apart by their names. The longest route and the previous delay share one window
    order, hence one sort. `partitions` deals the trips out to that many tasks: a table stored in
    as many buckets then takes them as they are, without another shuffle. `own` names a column that
    keeps the route that a stop tells by itself.
    """
    if partitions:
        rows = rows.repartition(partitions, *TRIP)
    ranked = F.struct(usable_length(F.col("route")).alias("length"), F.col("route"))
    return (
        rows
        .withColumns({
            "full_route": F.max(ranked).over(_whole_trip())["route"],
            "delay_change_vs_previous_observed_stop":
                _latest_delay() - F.lag(_latest_delay()).over(_trip_order()),
        })
        .withColumn("origin", route_origin(F.col("full_route")))
        .withColumn("destination", route_destination(F.col("full_route")))
        .withColumnsRenamed({"route": own} if own else {}).drop("route")
    )


def stop_table(observations: DataFrame, local_date: bool = False,
               partitions: int = 0) -> DataFrame:
    """One row per stop: the last observation, its route, and the change of delay against the
    previous observed stop of the trip. For `partitions` see `along_trips`.

    Without it the trips are dealt out before anything is derived from the columns: left to the
    windows, the shuffle would carry both, and what they compare.
    """
    last = last_observation(_told_by_stop_id(observations))
    if not partitions:
        last = last.repartition(_trip_key(), F.col("start_at"))
    return along_trips(stop_rows(last, local_date), partitions)


def trip_table(stops: DataFrame, identity: str = "first") -> DataFrame:
    """One row per trip, built from its first and last observed stop.

    The identity columns come from the first observed stop; with `identity="any"` they come
    from the first stop that has a category, so a trip whose first stop could not be
    identified is not lost to the long-distance tables.
    """
    order = F.struct(*_STOP_ORDER)
    identity_columns = ["train_category", "train_number", "train_operator", "train_brand",
                        "origin", "destination", "service_date", "is_long_distance"]
    identity_order = order if identity == "first" else F.struct(
        F.col("train_category").isNull().alias("unknown"), *_STOP_ORDER)
    first = F.struct(
        F.col("station_name").alias("station"), F.col("planned_departure_at").alias("planned"),
        F.col("changed_departure_at").alias("changed"),
        F.col("departure_delay_minutes").alias("delay"))
    last = F.struct(
        F.col("station_name").alias("station"), F.col("planned_arrival_at").alias("planned"),
        F.col("changed_arrival_at").alias("changed"),
        F.col("arrival_delay_minutes").alias("delay"))
    trips = stops.groupBy(*TRIP).agg(
        F.min_by(F.struct(*identity_columns), identity_order).alias("identity"),
        F.min_by(first, order).alias("first"),
        F.max_by(last, order).alias("last"),
        F.count(F.lit(1)).alias("observed_stop_count"),
        F.max(F.coalesce("is_cancelled", F.lit(False))).alias("any_stop_cancelled"),
    )
    return trips.select(
        *TRIP, "identity.*",
        F.col("first.station").alias("first_observed_station"),
        F.col("first.planned").alias("first_observed_planned_departure"),
        F.col("first.changed").alias("first_observed_actual_departure"),
        F.col("first.delay").alias("departure_delay_at_first_observed"),
        F.col("last.station").alias("last_observed_station"),
        F.col("last.planned").alias("last_observed_planned_arrival"),
        F.col("last.changed").alias("last_observed_actual_arrival"),
        F.col("last.delay").alias("arrival_delay_at_last_observed"),
        (F.col("last.delay") - F.col("first.delay")).alias("delay_change_over_observed_span"),
        "observed_stop_count", "any_stop_cancelled",
    )


def _pct(condition: Column, whole: Column) -> Column:
    return share(F.count_if(condition), whole)


def daily_route_table(trips: DataFrame, exclude_cancelled: bool = False) -> DataFrame:
    """Delay and punctuality per day and route, long-distance trips only.

    Shares of delays are over trips with a known delay, the cancellation rate over all trips.
    `exclude_cancelled` leaves cancelled trips out of the delay figures.
    """
    delay = F.col("arrival_delay_at_last_observed")
    if exclude_cancelled:
        delay = F.when(~F.col("any_stop_cancelled"), delay)
    rows = trips.filter("is_long_distance").select(
        "service_date", "origin", "destination", delay.alias("delay"), "any_stop_cancelled")
    daily = rows.groupBy("service_date", "origin", "destination").agg(
        F.count(F.lit(1)).alias("trips_observed"),
        F.avg("delay").alias("avg_arrival_delay_minutes"),
        percentile_array("delay", [0.5, 0.9, 0.95]).alias("p"),
        _pct(F.col("delay").between(-999, 5), F.count("delay")).alias("pct_within_5_min"),
        _pct(F.col("delay") > 15, F.count("delay")).alias("pct_over_15_min"),
        _pct(F.col("any_stop_cancelled"), F.count(F.lit(1))).alias("cancellation_rate"),
    )
    return daily.select(
        "service_date", "origin", "destination", "trips_observed",
        "avg_arrival_delay_minutes",
        F.get("p", F.lit(0)).cast("double").alias("median_arrival_delay_minutes"),
        F.get("p", F.lit(1)).cast("double").alias("p90_arrival_delay_minutes"),
        F.get("p", F.lit(2)).cast("double").alias("p95_arrival_delay_minutes"),
        "pct_within_5_min", "pct_over_15_min", "cancellation_rate",
    )


def consecutive_stops(stops: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every long-distance stop next to the previous observed one of its trip.

    Other trains are dropped before the neighbours are looked up, as that changes them.
    """
    w = _trip_order()

    def before(column: str) -> Column:
        return F.lag(column).over(w)

    return stops.filter("is_long_distance").select(
        *TRIP, *keep,
        before("station_name").alias("from_station"),
        F.col("station_name").alias("to_station"),
        (F.col("stop_index") - before("stop_index")).alias("hops"),
        (F.col("arrival_delay_minutes") - before("arrival_delay_minutes"))
        .alias("delay_gained"),
        before("arrival_delay_minutes").alias("delay_at_from"),
        F.col("arrival_delay_minutes").alias("delay_at_to"),
        planned_minutes(F.col("planned_arrival_at"), before("planned_departure_at"))
        .alias("planned_minutes"),
        (F.coalesce("is_cancelled", F.lit(False))
         | F.coalesce(before("is_cancelled"), F.lit(False))).alias("either_cancelled"),
    )


def with_coordinates(segments: DataFrame, stations: DataFrame) -> DataFrame:
    """Coordinates of both ends, by station name.

    Joined after the aggregation, so one row per segment meets the stations instead of one
    per trip. The names have to be unique (`checks.check_station_names`). Spark broadcasts
    the stations while they are below its size threshold and shuffles them beyond it.
    """
    def end(prefix: str) -> DataFrame:
        return stations.filter("station_name IS NOT NULL").select(
            F.col("station_name").alias(f"{prefix}_station"),
            F.col("latitude").alias(f"{prefix}_latitude"),
            F.col("longitude").alias(f"{prefix}_longitude"))

    return segments.join(end("from"), "from_station", "left") \
        .join(end("to"), "to_station", "left")


def usable_sections(stops: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Consecutive stops that say how much delay was gained between them."""
    return consecutive_stops(stops, keep).filter(
        F.col("from_station").isNotNull() & F.col("delay_gained").isNotNull()
        & ~F.col("either_cancelled"))


def segment_table(stops: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Delay gained between consecutive observed stops, per (from, to, hops)."""
    gained = F.col("delay_gained")
    segments = usable_sections(stops).groupBy("from_station", "to_station", "hops").agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.avg(gained), 2).alias("avg_delay_gained_minutes"),
        percentile_array("delay_gained", [0.5, 0.9]).alias("p"),
        F.round(F.avg("delay_at_from"), 1).alias("avg_delay_at_from"),
        F.round(F.avg("delay_at_to"), 1).alias("avg_delay_at_to"),
        F.round(F.avg("planned_minutes"), 1).alias("avg_planned_minutes"),
        F.count_if(gained > 0).alias("trips_losing_time"),
        F.count_if(gained < 0).alias("trips_recovering_time"),
    )
    columns = [
        "from_station", "to_station", "hops", "trips", "avg_delay_gained_minutes",
        F.get("p", F.lit(0)).cast("double").alias("median_delay_gained_minutes"),
        F.get("p", F.lit(1)).cast("double").alias("p90_delay_gained_minutes"),
        "avg_delay_at_from", "avg_delay_at_to", "avg_planned_minutes",
        "trips_losing_time", "trips_recovering_time",
    ]
    segments = segments.select(*columns)
    return segments if stations is None else with_coordinates(segments, stations)


def journeys(stops: DataFrame, usable_only: bool = False, keep: Sequence[str] = ()
             ) -> DataFrame:
    """Every stop of a long-distance trip with every later one: what a traveller can ride.

    Each stop unfolds into the stops behind it, which the window over its trip hands it. A
    self join would compute the stop table twice; this reads it once, in the order the other
    trip windows use. `usable_only` leaves out, before pairs are formed, cancelled stops and
    ends whose delay is unknown.
    """
    rows = stops.filter("is_long_distance AND trip_id IS NOT NULL AND start_at IS NOT NULL")
    cancelled = F.coalesce("is_cancelled", F.lit(False))
    end = F.struct(
        "stop_index", "station_name", "arrival_delay_minutes", "planned_arrival_at",
        cancelled.alias("is_cancelled"))
    if usable_only:
        rows = rows.filter(~cancelled)
        end = F.when(F.col("arrival_delay_minutes").isNotNull(), end)
    behind = F.collect_list(end).over(
        _trip_order().rowsBetween(1, Window.unboundedFollowing))
    starts = rows.select(
        *keep, "trip_id", "stop_index", "station_name", "train_category", "train_number",
        "service_date", "departure_delay_minutes", "planned_departure_at",
        cancelled.alias("is_cancelled"), behind.alias("behind"))
    if usable_only:
        starts = starts.filter("departure_delay_minutes IS NOT NULL")
    pairs = starts.withColumn("b", F.explode("behind")).filter("b.stop_index > stop_index")
    return pairs.select(
        *keep, "trip_id",
        F.col("stop_index").alias("from_index"), F.col("b.stop_index").alias("to_index"),
        F.col("station_name").alias("from_station"),
        F.col("b.station_name").alias("to_station"),
        "train_category", "train_number", "service_date",
        F.col("departure_delay_minutes").alias("departure_delay_at_from"),
        F.col("b.arrival_delay_minutes").alias("arrival_delay_at_to"),
        (F.col("b.arrival_delay_minutes") - F.col("departure_delay_minutes"))
        .alias("delay_gained"),
        planned_minutes(F.col("b.planned_arrival_at"), F.col("planned_departure_at"))
        .alias("planned_journey_minutes"),
        (F.col("b.stop_index") - F.col("stop_index")).alias("stops_between"),
        (F.col("is_cancelled") | F.col("b.is_cancelled")).alias("either_cancelled"),
    )


def station_pair_table(stops: DataFrame, approximate_distinct: bool = False) -> DataFrame:
    """Delay from A to B on direct trains, cancelled stops and unknown delays left out.

    Days and trains of a pair are counted as sets, which merge before the shuffle: as many
    entries as days were observed and trains run there. Two distinct counts would make Spark
    expand every row threefold. `approximate_distinct` replaces the sets by sketches.
    """
    delay = F.col("arrival_delay_at_to")

    def distinct(column: str) -> Column:
        if approximate_distinct:
            return F.approx_count_distinct(column)
        return F.size(F.collect_set(column)).cast("long")

    count = F.count(F.lit(1))
    pairs = journeys(stops, usable_only=True).groupBy("from_station", "to_station").agg(
        count.alias("direct_trains"),
        distinct("service_date").alias("days_observed"),
        F.round(F.avg("planned_journey_minutes"), 0).alias("avg_planned_journey_minutes"),
        F.round(F.avg(delay), 1).alias("avg_arrival_delay_minutes"),
        percentile_array("arrival_delay_at_to", [0.5, 0.9, 0.95]).alias("p"),
        F.round(F.avg("delay_gained"), 1).alias("avg_delay_gained_minutes"),
        F.round(_pct(delay <= 5, count), 1).alias("pct_within_5_min"),
        F.round(_pct(delay > 15, count), 1).alias("pct_over_15_min"),
        F.round(F.avg("stops_between"), 1).alias("avg_stops_between"),
        distinct("train_number").alias("distinct_services"),
    )
    return pairs.select(
        "from_station", "to_station", "direct_trains", "days_observed",
        "avg_planned_journey_minutes", "avg_arrival_delay_minutes",
        F.get("p", F.lit(0)).cast("double").alias("median_arrival_delay_minutes"),
        F.get("p", F.lit(1)).cast("double").alias("p90_arrival_delay_minutes"),
        F.get("p", F.lit(2)).cast("double").alias("p95_arrival_delay_minutes"),
        "avg_delay_gained_minutes", "pct_within_5_min", "pct_over_15_min",
        "avg_stops_between", "distinct_services",
    )


def top_routes(trips: DataFrame, limit: int = 20, min_trips: int = 3) -> DataFrame:
    """Long-distance routes with most trips."""
    return (
        trips.filter("is_long_distance AND origin IS NOT NULL")
        .groupBy("origin", "destination")
        .agg(F.count(F.lit(1)).alias("trips"),
             F.round(F.avg("arrival_delay_at_last_observed"), 1).alias("avg_delay"))
        .filter(F.col("trips") >= min_trips)
        .orderBy(F.col("trips").desc(), F.col("origin"), F.col("destination"))
        .limit(limit)
    )


def sample_routes(trips: DataFrame, limit: int = 20) -> DataFrame:
    """All routes by trips, the unknown one included."""
    return (
        trips.groupBy("origin", "destination")
        .agg(F.count(F.lit(1)).alias("trips"),
             F.round(F.avg("observed_stop_count"), 1).alias("avg_stops_observed"),
             F.round(F.avg("arrival_delay_at_last_observed"), 1).alias("avg_delay_min"))
        .orderBy(F.col("trips").desc(), F.col("origin").asc_nulls_first(),
                 F.col("destination").asc_nulls_first())
        .limit(limit)
    )


def top_segments(segments: DataFrame, limit: int = 15, min_trips: int = 5) -> DataFrame:
    """Adjacent sections that lose most time."""
    return (
        segments.filter((F.col("hops") == 1) & (F.col("trips") >= min_trips))
        .select("from_station", "to_station", "trips", "avg_delay_gained_minutes",
                "avg_planned_minutes")
        .orderBy(F.col("avg_delay_gained_minutes").desc(), "from_station", "to_station")
        .limit(limit)
    )


def top_pairs(pairs: DataFrame, limit: int = 15, min_trips: int = 5) -> DataFrame:
    """Pairs with most direct trains."""
    return (
        pairs.filter(F.col("direct_trains") >= min_trips)
        .select("from_station", "to_station", "direct_trains", "avg_arrival_delay_minutes",
                "median_arrival_delay_minutes", "p90_arrival_delay_minutes",
                "pct_within_5_min", "avg_planned_journey_minutes")
        .orderBy(F.col("direct_trains").desc(), "from_station", "to_station")
        .limit(limit)
    )


def in_presentation_order(daily: DataFrame) -> DataFrame:
    """Newest day first, then the busiest route; ties by name."""
    return daily.orderBy(F.col("service_date").desc(), F.col("trips_observed").desc(),
                         "origin", "destination")


def save_stops(stops: DataFrame, table: str, buckets: int) -> None:
    """Store the stop table hashed by trip and sorted along it.

    Trip, segment and pair jobs then read it without shuffle. What the stops were shuffled through
    is gone when they are stored.
    """
    with spent_shuffles(stops.sparkSession):
        overwrite_table(stops, table, bucket_by=TRIP, sort_by=_STOP_ORDER, buckets=buckets)


def in_days(observations: DataFrame, first: str, last: str) -> DataFrame:
    """Observations of the days from `first` to `last`.

    Silver stored by `observed_date` reads only the folders of those days.
    """
    day = "observed_date" if "observed_date" in observations.columns else None
    moment = F.col(day) if day else F.to_date("observed_at")
    return observations.filter(moment.between(F.lit(first).cast("date"),
                                              F.lit(last).cast("date")))


def build_gold(observations: DataFrame, stations: DataFrame, database: str,
               buckets: int = 200, tracks: DataFrame | None = None,
               circular: bool = True) -> None:
    """Write the eight tables of the delay model, each once, later ones from the stored stops.

    The rules that later steps rest on are enforced before those steps: unique station names,
    and trips no longer than a train can be before any window over trips. The others are counted
    while the stops are written (`checks.Counted`). `tracks` are the resolved segment geometries.
    `circular` refuses routes that end where they begin. The tables hold what `observations`
    holds, nothing else: `increment.update` adds to what is there. What a table was shuffled through,
    and the last observations behind the stops, go when it is stored.
    """
    spark = observations.sparkSession
    collapsed = scratch_dir(spark, "collapsed")
    try:
        with spent_shuffles(spark):
            _build(observations, stations, database, buckets, tracks, circular, collapsed)
    finally:
        remove_scratch(spark, collapsed)


def _build(observations: DataFrame, stations: DataFrame, database: str, buckets: int,
           tracks: DataFrame | None, circular: bool, collapsed: str) -> None:
    spark = observations.sparkSession
    create_database(spark, database)
    checks.enforce(checks.check_station_names(stations))
    overwrite_table(stations, f"{database}.station")
    stations = spark.table(f"{database}.station")
    counted = checks.Counted()
    counted.collapsed(stop_rows(last_observation(observations))) \
        .write.option("compression", DENSE).parquet(collapsed)
    rows = spark.read.parquet(collapsed)
    checks.enforce(checks.check_trip_length(rows))
    save_stops(counted.written(along_trips(rows, buckets)), f"{database}.stop", buckets)
    checks.enforce(counted.report(spark, circular))
    remove_scratch(spark, collapsed)
    stops = spark.table(f"{database}.stop")

    overwrite_table(trip_table(stops), f"{database}.trip")
    overwrite_table(daily_route_table(spark.table(f"{database}.trip")),
                    f"{database}.daily_route", partition_by=["service_date"])
    overwrite_table(segment_table(stops, stations), f"{database}.segment")
    overwrite_table(station_pair_table(stops), f"{database}.station_pair")
    if tracks is None:
        tracks = spark.createDataFrame([], S.SEGMENT_GEOMETRY)
    overwrite_table(geometry.segment_geometry_table(tracks, spark.table(f"{database}.segment")),
                    f"{database}.segment_geometry")
    overwrite_table(
        geometry.geometry_points_table(spark.table(f"{database}.segment_geometry")),
        f"{database}.segment_point")
