"""Coordinates of places from a gazetteer, with a second dictionary to fall back on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import vocabulary
from ..functions.text import gazetteer_key, python_strip
from .lookup import left_lookup
from .names import resolve_names


def _fixed_table(spark: SparkSession, key: str, rows: list[tuple[str, float, float]]) -> DataFrame:
    keys, lats, lons = zip(*rows)
    return spark.createDataFrame(pa.table({key: keys, "lat": lats, "lon": lons}))


def gazetteer_table(spark: SparkSession) -> DataFrame:
    return _fixed_table(spark, "key", vocabulary.GAZETTEER)


def collection_points(spark: SparkSession) -> DataFrame:
    return _fixed_table(spark, "name", vocabulary.COLLECTION_POINTS)


def _located(point: str) -> Column:
    return F.col(point)["lat"].isNotNull() & F.col(point)["lon"].isNotNull()


def geocode(
    df: DataFrame,
    name_col: str,
    gazetteer: DataFrame | None = None,
    fallback: DataFrame | None = None,
    *,
    raw_col: str | None = None,
    country: str = vocabulary.COUNTRY,
) -> DataFrame:
    """Add ``lat``, ``lon`` and ``geocode_source``.

    The gazetteer ``(key, lat, lon)`` is asked for ``name|country``; where it has
    no entry the fallback ``(name, lat, lon)`` is asked for the raw name. The
    source is ``cache``, ``settings_fallback`` or ``unresolved``. Where a given
    dictionary repeats a key (fallback names differing only in case are the same
    key), its smallest latitude, then longitude counts, so no row is multiplied;
    entries of a given dictionary that lack a coordinate are no entries.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in ("lat", "lon", "geocode_source")]
    cached = (gazetteer if gazetteer is not None else gazetteer_table(spark)).select(F.col("key").alias("_key"), F.struct("lat", "lon").alias("_cached"))
    listed = (fallback if fallback is not None else collection_points(spark)).select(F.lower("name").alias("_raw"), F.struct("lat", "lon").alias("_listed"))
    cached, listed = cached.filter(_located("_cached")), listed.filter(_located("_listed"))
    keyed = df.select(
        *kept,
        gazetteer_key(F.col(name_col), F.lit(country)).alias("_key"),
        F.lower(python_strip(F.col(raw_col or name_col))).alias("_raw"),
    )
    # The built-in dictionaries have a fixed size; a given one is measured.
    if gazetteer is None:
        found = keyed.join(F.broadcast(cached), "_key", "left")
    else:
        found = left_lookup(keyed, cached.groupBy("_key").agg(F.min("_cached").alias("_cached")), ["_key"], compute_once=False)
    if fallback is None:
        found = found.join(F.broadcast(listed), "_raw", "left")
    else:
        found = left_lookup(found, listed.groupBy("_raw").agg(F.min("_listed").alias("_listed")), ["_raw"], compute_once=False)
    return found.select(
        *kept,
        F.coalesce("_cached", "_listed")["lat"].alias("lat"),
        F.coalesce("_cached", "_listed")["lon"].alias("lon"),
        F.when(F.col("_cached").isNotNull(), "cache")
        .when(F.col("_listed").isNotNull(), "settings_fallback")
        .otherwise("unresolved")
        .alias("geocode_source"),
    )


def resolve_and_geocode(
    df: DataFrame,
    name_col: str,
    aliases: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    fallback: DataFrame | None = None,
) -> DataFrame:
    """Canonical name, province, match flag and coordinates of a raw place name."""
    resolved = resolve_names(df, name_col, aliases)
    return geocode(resolved, "canonical", gazetteer, fallback, raw_col=name_col)
