"""Shares, percentiles, and expressions worth computing only once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """100 * part / whole as double; NULL for an empty whole."""
    return part.cast("double") * 100 / F.nullif(whole, F.lit(0)).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """The share as text with two decimals, `n/a` for an empty whole."""
    value = F.format_string("%.2f%%", share(part, whole))
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit("n/a")).otherwise(value)


def percentile_array(column: str, points: list[float], approximate: bool = False) -> Column:
    """The smallest values at or beyond each share of a group: elements of it, in one array.

    Exact: the group is kept as counts per different value, which merge before the shuffle.
    Delays are whole minutes, so that is a few hundred entries however many rows there are.
    `approximate` is for columns with very many different values: one sketch for all points.
    """
    if approximate:
        return F.percentile_approx(column, [float(p) for p in points])
    return F.array(*[
        F.expr(f"percentile_disc({float(p)}) WITHIN GROUP (ORDER BY `{column}`)")
        for p in points])


def computed_once(value: Column) -> Column:
    """`value` behind a one-element explode, one row in, one row out.

    Filters on its parts then stay above it. Inlined, they would be pushed below the
    projection with a copy of the expression each, and a parser would read every text
    several times.
    """
    return F.explode(F.array(value))
