"""Column helpers. Every one is a built-in expression, so it stays inside the JVM."""

from .identity import (
    LONG_DISTANCE_CATEGORIES,
    brand_fallback,
    cancel_flag,
    content_digest,
    in_scope,
    is_long_distance,
    is_strict_long_distance,
    platform_change,
    split_stop_id,
)
from .numbers import computed_once, percent, percentile_array, share
from .routes import (
    downsample,
    path_array,
    point_at,
    route_build,
    route_destination,
    route_origin,
    segment_label,
    track_km,
    usable_length,
)
from .times import (
    BERLIN,
    db_timestamp,
    delay_minutes,
    iso_timestamp,
    planned_minutes,
    service_date,
)

__all__ = [
    "BERLIN", "LONG_DISTANCE_CATEGORIES", "brand_fallback", "cancel_flag",
    "computed_once", "content_digest", "db_timestamp", "delay_minutes", "downsample", "in_scope",
    "is_long_distance", "is_strict_long_distance", "iso_timestamp", "path_array",
    "percent", "percentile_array", "planned_minutes", "platform_change", "point_at",
    "route_build", "route_destination", "route_origin", "segment_label", "service_date",
    "share", "split_stop_id", "track_km", "usable_length",
]
