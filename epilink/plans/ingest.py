"""Raw rows to complete messages: places resolved, coordinates, week or month, ids, text keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas, vocabulary
from ..functions.records import prefixed_id, record_id, with_source
from ..functions.temporal import (
    alert_sentence,
    epi_week,
    epi_year,
    epoch_seconds_now,
    extract_temporal_key,
    iso_utc,
    iso_utc_now,
    month_label,
    week_key,
)
from ..operators.geo import resolve_and_geocode
from ..sources.payloads import flatten_weather, parse_feed_items


def _placed(df: DataFrame, day: Column | None, dictionaries: dict) -> DataFrame:
    """Add the resolved place, its coordinates and the week of ``day`` (today by default)."""
    day = day if day is not None else F.current_date()
    dated = df.withColumns({"epi_year": epi_year(day), "epi_week": epi_week(day)})
    return resolve_and_geocode(dated, "district", **dictionaries).withColumnRenamed(
        "canonical", "district_canonical"
    )


def _fit(df: DataFrame, kind: str) -> DataFrame:
    """Exactly the columns and types of the message schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.MESSAGES[kind]])


def surveillance_records(df: DataFrame, day: Column | None = None, **dictionaries: DataFrame) -> DataFrame:
    """From ``district, disease, case_count, idsr_compliance_pct``."""
    rows = with_source(_placed(df, day, dictionaries), vocabulary.SOURCE_TAGS["surveillance"])
    identity = ["district", "disease", "epi_year", "epi_week", "case_count", "idsr_compliance_pct"]
    return _fit(rows.withColumns({"record_id": record_id(identity), "ingestion_ts": iso_utc_now()}), "surveillance")


def weather_records(df: DataFrame, payload_col: str = "value", day: Column | None = None, **dictionaries: DataFrame) -> DataFrame:
    """From ``district`` and a current-weather JSON payload."""
    rows = with_source(_placed(flatten_weather(df, payload_col), day, dictionaries), vocabulary.SOURCE_TAGS["weather"])
    return _fit(rows.withColumn("timestamp", epoch_seconds_now()), "weather")


def alert_records(df: DataFrame, issued: Column | None = None, **dictionaries: DataFrame) -> DataFrame:
    """From ``district, event_type, severity`` and optionally ``description``.

    A missing description is composed; the date it mentions gives the alert's
    temporal key, and the week of issue is used where it mentions none.
    """
    issued = issued if issued is not None else F.current_timestamp()
    composed = alert_sentence(F.col("event_type"), F.col("district"), issued, F.col("severity"))
    description = F.coalesce(F.col("description"), composed) if "description" in df.columns else composed
    identity = ["district", "event_type", "severity", "description", "issued_at"]
    rows = df.withColumns(
        {"description": description, "issued_at": iso_utc(issued)}
    ).withColumns(
        {
            "record_id": record_id(identity),
            "alert_id": prefixed_id(identity, vocabulary.ALERT_ID_PREFIX),
            "extracted_temporal_key": extract_temporal_key(F.col("description"), week_key(issued)),
        }
    )
    return _fit(with_source(_placed(rows, issued, dictionaries), vocabulary.SOURCE_TAGS["alerts"]), "alerts")


def policy_records(df: DataFrame, reported: Column | None = None) -> DataFrame:
    """From ``title, policy_type, status, year, summary, sectors``; keyed by month."""
    reported = reported if reported is not None else F.current_timestamp()
    identity = ["title", "policy_type", "status", "year", "report_month_label"]
    rows = df.withColumns(
        {
            "report_month": F.month(reported),
            "report_year": F.year(reported),
            "report_month_label": month_label(reported),
            "ingestion_ts": iso_utc_now(),
        }
    ).withColumn("record_id", record_id(identity))
    return _fit(with_source(rows, vocabulary.SOURCE_TAGS["policy"]), "policy")


def news_records(df: DataFrame, xml_col: str, source_col: str = "source", n: int = vocabulary.ITEMS_PER_FEED) -> DataFrame:
    """First ``n`` items of each feed document, in feed order."""
    items = parse_feed_items(df, xml_col, source_col)
    return _fit(items.where(F.col("position") < n), "news")
