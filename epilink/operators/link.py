"""Cross-source link: cases with weekly weather means and weekly alerts of the same place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocabulary
from .lookup import BROADCAST_LIMIT_BYTES, left_lookup

KEYS = ("district_canonical", "epi_week_key")

# Mean column -> measured column.
WEATHER_MEANS = {
    "avg_temperature_c": "temperature_c",
    "avg_humidity_pct": "humidity_pct",
    "avg_precipitation_mm": "precipitation_mm",
    "avg_wind_speed_kmh": "wind_speed_kmh",
}


def weekly_means(
    weather: DataFrame, keys: Sequence[str] = KEYS, means: Mapping[str, str] = WEATHER_MEANS
) -> DataFrame:
    """One row per key with the mean of each measure; missing values are skipped."""
    present = weather.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(
        *[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(name) for name, c in means.items()]
    )


def weekly_alerts(
    alerts: DataFrame,
    keys: Sequence[str] = KEYS,
    *,
    severity: str = "mode",
    scale: Sequence[str] = vocabulary.SEVERITY_SCALE,
) -> DataFrame:
    """One row per key: number of alerts, their severity and their kinds.

    ``severity="mode"`` is the most frequent value (the smallest on ties),
    ``"rank"`` the highest on ``scale``. Rows are first counted per key, severity
    and kind, which leaves a handful of rows per key whatever their number; the
    second shuffle on the key alone then serves both remaining groupings.
    """
    counted = (
        alerts.dropna(subset=list(keys))
        .groupBy(*keys, "severity", "event_type")
        .agg(F.count("alert_id").alias("_alerts"), F.count(F.lit(1)).alias("_rows"))
        .repartition(*keys)
    )
    by_severity = counted.groupBy(*keys, "severity").agg(
        F.sum("_alerts").alias("_alerts"),
        F.sum("_rows").alias("_rows"),
        F.collect_set("event_type").alias("_types"),
    )
    types = F.array_sort(F.array_distinct(F.flatten(F.collect_list("_types"))))
    return by_severity.groupBy(*keys).agg(
        F.sum("_alerts").alias("disaster_event_count"),
        _severity(severity, scale).alias("max_severity"),
        F.when(F.size(types) > 0, F.array_join(types, ", ")).alias("event_types"),
    )


def _severity(how: str, scale: Sequence[str]) -> Column:
    value = F.col("severity")
    if how == "mode":
        # Most rows first, then the smallest value; a null severity is never chosen.
        return F.min_by(value, F.when(value.isNotNull(), F.struct(-F.col("_rows"), value)))
    if how == "rank":
        position = F.array_position(F.array(*[F.lit(s) for s in scale]), value)
        return F.max_by(value, F.when(position > 0, position))
    raise ValueError(f"severity must be 'mode' or 'rank', not {how!r}")


def weekly_context(
    weather: DataFrame,
    alerts: DataFrame,
    keys: Sequence[str] = KEYS,
    *,
    severity: str = "mode",
    scale: Sequence[str] = vocabulary.SEVERITY_SCALE,
) -> DataFrame:
    """Weather means and alerts side by side, one row per key that either has."""
    means = weekly_means(weather, keys)
    events = weekly_alerts(alerts, keys, severity=severity, scale=scale)
    return means.join(events, list(keys), "full")


def link_sources(
    cases: DataFrame,
    weather: DataFrame,
    alerts: DataFrame,
    keys: Sequence[str] = KEYS,
    *,
    weeks: tuple[str, str] | None = None,
    severity: str = "mode",
    scale: Sequence[str] = vocabulary.SEVERITY_SCALE,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Every case row with the weather and the alerts of its place and week.

    Both smaller sources are reduced to one row per place and week and joined
    with each other, so the case rows meet one table once. That table is computed
    and measured; if it is small the case rows are not shuffled at all, else
    adaptive execution splits places and weeks with too many of them. ``weeks``
    (first and last key) prunes the weekly partitions of all three inputs.
    """
    if weeks is not None:
        first, last = weeks
        cases, weather, alerts = (
            df.where(F.col(keys[-1]).between(first, last)) for df in (cases, weather, alerts)
        )
    context = weekly_context(weather, alerts, keys, severity=severity, scale=scale)
    linked = left_lookup(cases, context, keys, limit_bytes=limit_bytes)
    flagged = linked.withColumn(
        "has_concurrent_disaster", F.coalesce(F.col("disaster_event_count"), F.lit(0)) > 0
    )
    added = [c for c in flagged.columns if c not in cases.columns]
    return flagged.select(*cases.columns, *added)


def can_link(cases: DataFrame, weather: DataFrame) -> bool:
    """A link needs cases and weather; alerts are optional."""
    return not cases.isEmpty() and not weather.isEmpty()
