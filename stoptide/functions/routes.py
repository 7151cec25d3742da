"""Routes as arrays of station names, and track geometry as arrays of points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper target of the map sampling: one point in int(n / 60) is kept.
POINTS_PER_SEGMENT = 60


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def path_array(changed: Column, planned: Column) -> Column:
    """The changed path if there is one, else the planned one, without blank names."""
    path = F.coalesce(_blank_to_null(changed), _blank_to_null(planned))
    return F.filter(F.split(path, r"\|"), lambda name: F.trim(name) != "")


def route_build(path_from: Column, station: Column, path_to: Column) -> Column:
    """Where the train came from, this station, where it goes; NULL parts count as empty."""
    none = F.array().cast("array<string>")
    whole = F.concat(F.coalesce(path_from, none), F.array(station), F.coalesce(path_to, none))
    return F.filter(whole, lambda name: name.isNotNull() & (F.trim(name) != ""))


def usable_length(route: Column) -> Column:
    """A route of one name says nothing, so it ranks with the empty one."""
    size = F.size(route)
    return F.when(size >= 2, size).otherwise(0)


def route_origin(route: Column) -> Column:
    return F.when(F.size(route) >= 2, F.try_element_at(route, F.lit(1)))


def route_destination(route: Column) -> Column:
    return F.when(F.size(route) >= 2, F.try_element_at(route, F.lit(-1)))


def segment_label(from_station: Column, to_station: Column) -> Column:
    return F.concat(from_station, F.lit(" -> "), to_station)


def downsample(points: Column) -> Column:
    """Every k-th point with k = max(1, int(n / 60)): at most 119 points remain."""
    step = F.greatest(F.lit(1), (F.size(points) / POINTS_PER_SEGMENT).cast("int"))
    return F.filter(points, lambda _, i: i % step == 0)


def point_at(point: Column, index: int) -> Column:
    return F.get(point, F.lit(index))


def track_km(metres: Column) -> Column:
    return F.round(metres / 1000, 1)
