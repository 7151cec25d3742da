"""Instants, dates and delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BERLIN = "Europe/Berlin"


def db_timestamp(text: Column) -> Column:
    """YYMMDDHHMM in Berlin local time -> instant; NULL for text that is not a time.

    Needs a session in UTC (`session.require_utc`). In the spring gap the clock is moved
    on by the hour, in the autumn overlap the first (summer) reading is taken.
    """
    local = F.try_to_timestamp(F.concat(F.lit("20"), text), F.lit("yyyyMMddHHmm"))
    return F.to_utc_timestamp(local, BERLIN)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 with offset -> instant; NULL for anything else."""
    return F.try_to_timestamp(text)


def delay_minutes(planned: Column, changed: Column) -> Column:
    """Whole minutes, cut towards zero. NULL when either time is missing."""
    seconds = F.unix_timestamp(changed) - F.unix_timestamp(planned)
    return (seconds / 60).cast("int")


def planned_minutes(later: Column, earlier: Column) -> Column:
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 60


def service_date(departure: Column, arrival: Column, local_date: bool = False) -> Column:
    """Date of the planned departure, else of the planned arrival.

    The date is the UTC date; with `local_date` it is the Berlin date, which differs for
    trains between midnight and two o'clock.
    """
    moment = F.coalesce(departure, arrival)
    return F.to_date(F.from_utc_timestamp(moment, BERLIN) if local_date else moment)
