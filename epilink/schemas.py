"""Explicit schemas: nothing on a stream or in a log is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, I, L, D, TS = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType()


def fields(**types: DataType) -> StructType:
    """A schema from ``name=type``; every field may be null."""
    return StructType([StructField(name, type_) for name, type_ in types.items()])


# Fields of the messages and tables, in their order.
SURVEILLANCE = fields(
    record_id=S,
    source=S,
    epi_year=I,
    epi_week=I,
    district=S,
    district_canonical=S,
    province=S,
    lat=D,
    lon=D,
    disease=S,
    case_count=I,
    idsr_compliance_pct=D,
    ingestion_ts=S,
)

WEATHER = fields(
    source=S,
    district=S,
    district_canonical=S,
    province=S,
    lat=D,
    lon=D,
    epi_year=I,
    epi_week=I,
    temperature_c=D,
    humidity_pct=D,
    wind_speed_kmh=D,
    precipitation_mm=D,
    timestamp=D,
)

# extracted_temporal_key is sent with every alert, so it is kept as a column.
ALERTS = fields(
    record_id=S,
    alert_id=S,
    source=S,
    event_type=S,
    district=S,
    district_canonical=S,
    province=S,
    lat=D,
    lon=D,
    severity=S,
    epi_year=I,
    epi_week=I,
    issued_at=S,
    description=S,
    extracted_temporal_key=S,
)

POLICY = fields(
    record_id=S,
    source=S,
    title=S,
    policy_type=S,
    status=S,
    year=I,
    summary=S,
    sectors=ArrayType(S),
    report_month=I,
    report_year=I,
    report_month_label=S,
    ingestion_ts=S,
)

NEWS = fields(source=S, title=S, link=S, published=S)

MESSAGES = {
    "surveillance": SURVEILLANCE,
    "weather": WEATHER,
    "alerts": ALERTS,
    "policy": POLICY,
    "news": NEWS,
}

METRICS = fields(
    source=S,
    timestamp=S,
    records_attempted=L,
    records_succeeded=L,
    records_failed=L,
    success_rate=D,
    errors=ArrayType(S),
)

TRIPLES = fields(s=S, p=S, o=S, o_kind=S, o_datatype=S)

WEATHER_PAYLOAD = fields(
    current=fields(temperature_2m=D, relative_humidity_2m=D, wind_speed_10m=D, precipitation=D)
)

COORDINATES = fields(lat=D, lon=D, display_name=S)


def harmonised(kind: str) -> StructType:
    """Schema of a harmonised table: the message plus its key and processing time."""
    added = {"processed_at": TS}
    if kind in ("surveillance", "weather", "alerts"):
        added = {"epi_week_key": S, **added}
    return StructType(MESSAGES[kind].fields + fields(**added).fields)
