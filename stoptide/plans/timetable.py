"""Static timetable: calendar, sequences, time spans, and what a realtime feed covers."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import share
from ..operators.reconcile import sequence_class

# The calendar's weekday columns and the exception type that adds a service.
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
SERVICE_ADDED = "1"


def active_services(calendar: DataFrame, exceptions: DataFrame, date: str,
                    order: str | None = None) -> DataFrame:
    """Services that run on `date` (YYYYMMDD).

    The weekly calendar decides unless the date has exceptions; of several the last one in
    file order does, which `order` names (a line number).
    """
    weekday = WEEKDAYS[datetime.datetime.strptime(date, "%Y%m%d").weekday()]
    weekly = calendar.filter(
        (F.col("start_date") <= date) & (F.col("end_date") >= date) & (F.col(weekday) == "1")
    ).select("service_id", F.lit(True).alias("weekly"),
             F.lit(None).cast("string").alias("exception"),
             F.lit(None).cast("long").alias("line"))
    dated = exceptions.filter(F.col("date") == date).select(
        "service_id", F.lit(False).alias("weekly"),
        F.col("exception_type").alias("exception"),
        (F.col(order) if order else F.monotonically_increasing_id()).cast("long").alias("line"))
    merged = weekly.unionByName(dated).groupBy("service_id").agg(
        F.max("weekly").alias("weekly"), F.max_by("exception", "line").alias("exception"))
    runs = F.coalesce(F.col("exception") == SERVICE_ADDED, F.col("weekly"))
    return merged.filter(runs).select("service_id")


def service_days(calendar: DataFrame, exceptions: DataFrame, first: str, last: str,
                 order: str | None = None) -> DataFrame:
    """(service_id, w0, w1, …): the days from `first` to `last` (YYYYMMDD) as bits, 64 a word.

    The weekly calendar sets bits by weekday and range; dated exceptions are masks, of which the
    last one of a service and day counts. `active_services` for every day, from one pass over
    each table.
    """
    start = datetime.datetime.strptime(first, "%Y%m%d").date()
    days = [start + datetime.timedelta(days=i) for i in range(
        (datetime.datetime.strptime(last, "%Y%m%d").date() - start).days + 1)]
    words = [days[i:i + 64] for i in range(0, len(days), 64)]

    def weekly(part: list[datetime.date]) -> Column:
        """Days of the word on which the service runs by its weekdays, within its range."""
        out = F.lit(0).cast("long")
        for i, day in enumerate(part):
            text = day.strftime("%Y%m%d")
            on = (F.col(WEEKDAYS[day.weekday()]) == "1") & (F.col("start_date") <= text) \
                & (F.col("end_date") >= text)
            out = out.bitwiseOR(F.when(on, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(0))
        return out

    base = calendar.groupBy("service_id").agg(*[
        F.bit_or(weekly(part)).alias(f"base{k}") for k, part in enumerate(words)])
    number = F.date_diff(F.try_to_timestamp("date", F.lit("yyyyMMdd")).cast("date"),
                         F.lit(start))
    line = (F.col(order) if order else F.monotonically_increasing_id()).cast("long")
    dated = exceptions.filter(F.col("date").between(first, last)).select(
        "service_id", number.alias("day"), "exception_type", line.alias("line"),
    ).filter("day IS NOT NULL").groupBy("service_id", "day").agg(
        F.max_by("exception_type", "line").alias("kind"))
    bit = F.expr("shiftleft(1L, cast(pmod(day, 64) AS INT))")
    here = F.floor(F.col("day") / 64)
    masks = dated.groupBy("service_id").agg(*[
        F.bit_or(F.when((here == k) & kept, bit).otherwise(0)).alias(f"{name}{k}")
        for k in range(len(words))
        for name, kept in (("told", F.col("kind").isNotNull()), ("added", F.col("kind") == SERVICE_ADDED))])
    both = base.join(masks, "service_id", "full")

    def bits(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    return both.select("service_id", *[
        bits(f"base{k}").bitwiseAND(F.bitwise_not(bits(f"told{k}")))
        .bitwiseOR(bits(f"added{k}")).alias(f"w{k}") for k in range(len(words))])


def runs_on(first: str, date: str) -> Column:
    """Whether a service of `service_days` from `first` on runs on `date`."""
    start, day = (datetime.datetime.strptime(d, "%Y%m%d") for d in (first, date))
    word, i = divmod((day - start).days, 64)
    return F.getbit(F.col(f"w{word}"), F.lit(i)) == 1


def running_days(days: DataFrame, first: str) -> DataFrame:
    """(service_id, date YYYYMMDD) from the bits of `service_days`."""
    words = [c for c in days.columns if c != "service_id"]
    start = F.lit(datetime.datetime.strptime(first, "%Y%m%d").date())
    places = F.filter(F.sequence(F.lit(0), F.lit(64 * len(words) - 1)), lambda i: F.getbit(
        F.element_at(F.array(*words), (F.floor(i / 64) + 1).cast("int")), i % 64) == 1)
    return days.select("service_id", F.explode(places).alias("i")).select(
        "service_id", F.date_format(F.date_add(start, F.col("i")), "yyyyMMdd").alias("date"))


def trip_time_spans(stop_times: DataFrame) -> DataFrame:
    """First and last time of each trip as HH:MM:SS text; stops without a time are skipped."""
    moment = F.coalesce(F.nullif(F.col("departure_time"), F.lit("")),
                        F.nullif(F.col("arrival_time"), F.lit("")))
    return stop_times.select("trip_id", moment.alias("moment")) \
        .filter("moment IS NOT NULL").groupBy("trip_id") \
        .agg(F.min("moment").alias("first_time"), F.max("moment").alias("last_time"))


def trip_agencies(trips: DataFrame, routes: DataFrame, agency: DataFrame) -> DataFrame:
    """Trips with route and agency. An unknown agency is named '?'.

    The small sides are broadcast by Spark while they are below its size threshold.
    """
    return (
        trips.join(routes, "route_id")
        .join(agency, "agency_id", "left")
        .withColumn("agency_name", F.coalesce("agency_name", F.lit("?")))
    )


def matched_breakdown(trips: DataFrame, routes: DataFrame, agency: DataFrame,
                      feed_ids: DataFrame) -> DataFrame:
    """Trips of the feed per agency and route."""
    matched = trips.join(feed_ids.select("trip_id"), "trip_id", "left_semi")
    return trip_agencies(matched, routes, agency).groupBy(
        "agency_id", "agency_name", "route_short_name", "route_id"
    ).agg(F.count(F.lit(1)).alias("trips"))


def match_classes(feed_sequences: DataFrame, static_sequences: DataFrame) -> DataFrame:
    """How the stop sequences of trips known to both sides compare; a trip without static
    stops counts as an empty sequence."""
    none = F.array().cast("array<string>")
    pairs = feed_sequences.select("trip_id", F.col("stops").alias("feed")).join(
        static_sequences.select("trip_id", F.col("stops").alias("static")), "trip_id", "left")
    kind = sequence_class(F.col("feed"), F.coalesce("static", none))
    return pairs.select("trip_id", kind.alias("match_class"))


def _seconds(text: Column) -> Column:
    parts = F.split(text, ":")
    return sum((F.get(parts, F.lit(i)).try_cast("int") * f
                for i, f in enumerate((3600, 60, 1))), F.lit(0))


def trip_state(first: Column, last: Column, now: Column, overnight: bool = False) -> Column:
    """running, not yet started or already finished at `now` (HH:MM:SS).

    Times compare as text and trips past midnight are not corrected; with `overnight` they
    compare in seconds, and a trip of the day before that is still running counts as such.
    """
    if overnight:
        lo, hi, moment = _seconds(first), _seconds(last), _seconds(now)
        running = moment.between(lo, hi) | (moment + 86_400).between(lo, hi)
        later = lo > moment
    else:
        lo, hi, moment = F.coalesce(first, F.lit("")), F.coalesce(last, F.lit("")), now
        running = moment.between(lo, hi)
        later = lo > moment
    return (F.when(running, F.lit("running")).when(later, F.lit("not yet started"))
            .otherwise(F.lit("already finished")))


def trip_coverage(trips: DataFrame, routes: DataFrame, spans: DataFrame, active: DataFrame,
                  feed_ids: DataFrame, now: Column, overnight: bool = False) -> DataFrame:
    """Active trips with their agency, state at `now`, and whether the feed carries them."""
    running = trips.join(active, "service_id", "left_semi")
    seen = feed_ids.select("trip_id").distinct().withColumn("covered", F.lit(True))
    return (
        running.join(routes.select("route_id", "agency_id"), "route_id")
        .join(spans, "trip_id", "left").join(seen, "trip_id", "left")
        .select("trip_id", "agency_id",
                trip_state(F.col("first_time"), F.col("last_time"), now, overnight)
                .alias("state"),
                F.coalesce("covered", F.lit(False)).alias("covered"))
    )


def active_trips(trips: DataFrame, routes: DataFrame, spans: DataFrame, active: DataFrame,
                 feed_ids: DataFrame) -> DataFrame:
    """Active trips with their agency, first and last time, and whether the feed carries them."""
    seen = feed_ids.select("trip_id").distinct().withColumn("covered", F.lit(True))
    return (
        trips.join(active, "service_id", "left_semi")
        .join(routes.select("route_id", "agency_id"), "route_id")
        .join(spans, "trip_id", "left").join(seen, "trip_id", "left")
        .select("trip_id", "agency_id", "first_time", "last_time",
                F.coalesce("covered", F.lit(False)).alias("covered"))
    )


# Minutes of a day; a text that is a time, which compares as its number does.
MINUTES = 1440
_TIME = r"^\d\d:[0-5]\d:[0-5]\d$"


def _minutes_below(text: Column, inclusive: bool) -> Column:
    """How many full minutes of the day (HH:MM:00) are before the text, or not after it."""
    times = F.transform(F.sequence(F.lit(0), F.lit(MINUTES - 1)), lambda m: F.format_string(
        "%02d:%02d:00", F.floor(m / 60).cast("int"), m % 60))
    odd = F.size(F.filter(times, lambda t: (t <= text) if inclusive else (t < text)))
    seconds = _seconds(text)
    number = F.floor(seconds / 60) + 1 if inclusive else F.ceil(seconds / 60)
    return F.when(text.rlike(_TIME), F.least(number, F.lit(MINUTES))).otherwise(odd).cast("int")


def coverage_by_minute(active: DataFrame) -> DataFrame:
    """(minute, state, covered, total) for each minute of the day: `trip_state` and coverage.

    A sweep over `active_trips`: a trip enters the states and leaves them at minutes that its
    times tell, so it is a few +1 and -1 events; the states at a minute are the running totals
    up to it. One pass over the trips and one sum per event minute, at most 1,441 a state; then
    the totals are taken along the day. Times compare as text, as in `trip_state`.
    """
    lo, hi = F.coalesce("first_time", F.lit("")), F.coalesce("last_time", F.lit(""))
    begin, end = _minutes_below(lo, False), _minutes_below(hi, True)
    known = active.select("covered", begin.alias("b"), end.alias("e"))

    def event(minute, state: str, by: int) -> Column:
        return F.struct(minute.cast("int").alias("m"), F.lit(state).alias("state"),
                        F.lit(by).alias("by"))

    zero, b, e = F.lit(0), F.col("b"), F.col("e")
    ends = F.greatest(b, e)                      # a trip that ends before it begins never runs
    events = F.array(
        event(zero, "not yet started", 1), event(b, "not yet started", -1),
        event(b, "running", 1), event(ends, "running", -1),
        event(ends, "already finished", 1))
    sums = known.select("covered", F.explode(events).alias("x")).groupBy(
        F.col("x.m").alias("m"), F.col("x.state").alias("state")).agg(
        F.sum(F.when(F.col("covered"), F.col("x.by")).otherwise(0)).alias("covered"),
        F.sum("x.by").alias("total"))
    states = F.array(*map(F.lit, ("not yet started", "running", "already finished")))
    grid = active.sparkSession.range(MINUTES).select(
        F.col("id").cast("int").alias("m"), F.explode(states).alias("state"))
    along = Window.partitionBy("state").orderBy("m").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return grid.join(sums, ["m", "state"], "left").select(
        F.format_string("%02d:%02d", F.floor(F.col("m") / 60).cast("int"), F.col("m") % 60)
        .alias("minute"), "state",
        *[F.sum(F.coalesce(c, F.lit(0))).over(along).alias(c) for c in ("covered", "total")])


def coverage_by_state(coverage: DataFrame, agency_id: str) -> DataFrame:
    """Covered and all trips per state, for all agencies and for one."""
    one = F.coalesce(F.col("agency_id") == agency_id, F.lit(False))
    counts = coverage.groupBy("state").agg(
        F.count_if("covered").alias("covered"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("covered") & one).alias("agency_covered"),
        F.count_if(one).alias("agency_total"))
    return counts.select(
        "*", share(F.col("covered"), F.col("total")).alias("pct"),
        share(F.col("agency_covered"), F.col("agency_total")).alias("agency_pct"))


def running_by_agency(coverage: DataFrame, agency: DataFrame) -> DataFrame:
    """Covered and all trips running at the feed's time, per agency with its name."""
    counts = coverage.filter("state = 'running'").groupBy("agency_id").agg(
        F.count_if("covered").alias("covered"), F.count(F.lit(1)).alias("total"))
    return counts.join(agency.select("agency_id", "agency_name"), "agency_id", "left").select(
        "agency_id", F.coalesce("agency_name", F.lit("?")).alias("agency_name"), "covered",
        "total", share(F.col("covered"), F.col("total")).alias("pct"))
