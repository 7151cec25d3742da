"""Who a stop, a train or a change is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CHANGE_FIELDS

# The train categories that count as long-distance.
LONG_DISTANCE_CATEGORIES = [
    "ICE", "IC", "EC", "ECE", "EN", "NJ", "RJ", "RJX", "TGV", "FLX", "TRI", "D",
]
# The scope flag of long-distance trains, the status of a cancelled leg.
LONG_DISTANCE_FLAG = "F"
CANCELLED = "c"

# Split from the right: the trip id may itself start with a minus sign.
_STOP_ID = r"^(.*)-([^-]*)-([^-]*)$"


def split_stop_id(stop_id: Column) -> tuple[Column, Column, Column]:
    """`{trip}-{start}-{index}` -> (trip, start, index); three NULLs if it does not parse."""
    index = F.regexp_extract(stop_id, _STOP_ID, 3).try_cast("int")
    trip = F.when(index.isNotNull(), F.regexp_extract(stop_id, _STOP_ID, 1))
    start = F.when(index.isNotNull(), F.regexp_extract(stop_id, _STOP_ID, 2))
    return trip, start, index


def brand_fallback(brand: Column, operator: Column) -> Column:
    return F.coalesce(brand, operator)


def cancel_flag(arrival_status: Column, departure_status: Column) -> Column:
    """True if either leg is cancelled; an absent status means "not cancelled"."""
    return (F.coalesce(arrival_status, F.lit("")) == CANCELLED) | (
        F.coalesce(departure_status, F.lit("")) == CANCELLED
    )


def is_long_distance(category: Column) -> Column:
    """NULL for an unknown category."""
    return category.isin(LONG_DISTANCE_CATEGORIES)


def in_scope(train_filter: Column) -> Column:
    """Drop only what is positively flagged as something else; keep what has no flag."""
    return train_filter.isNull() | (train_filter == LONG_DISTANCE_FLAG)


def is_strict_long_distance(train_filter: Column) -> Column:
    return train_filter == LONG_DISTANCE_FLAG


def content_digest(*fields: Column | str) -> Column:
    """Hash of the change fields, stable across runs; tells NULL, '' and position apart."""
    return F.sha2(
        F.to_json(F.struct(*(fields or CHANGE_FIELDS)), {"ignoreNullFields": "false"}), 256
    )


def platform_change(planned: Column, changed: Column) -> Column:
    """`planned->changed` if the platform moved, else the planned one, else ''."""
    moved = (F.coalesce(changed, F.lit("")) != "") & ~changed.eqNullSafe(planned)
    return (
        F.when(moved, F.concat(F.coalesce(planned, F.lit("")), F.lit("->"), changed))
        .otherwise(F.coalesce(planned, F.lit("")))
    )
