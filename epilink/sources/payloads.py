"""Payload columns (JSON, XML) to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from .. import schemas


def parse_json(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """Message bytes or text to the schema's columns.

    Missing fields are null and unknown ones are dropped; a malformed message
    stays as an all-null row.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(parsed.alias("d")).select("d.*")


def quarantine_json(
    df: DataFrame, schema: StructType, value_col: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Split messages into parsed rows and the raw text of malformed ones."""
    watched = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    text = F.col(value_col).cast("string")
    parsed = df.select(
        text.alias("raw_message"),
        F.from_json(text, watched, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("d"),
    )
    bad = F.col("d").isNull() | F.col("d._corrupt_record").isNotNull()
    good_rows = parsed.where(~bad).select("d.*").drop("_corrupt_record")
    return good_rows, parsed.where(bad).select("raw_message")


def explode_json_map(
    df: DataFrame, json_col: str, value_schema: StructType = schemas.COORDINATES
) -> DataFrame:
    """One row per entry of a JSON object ``key -> struct``; other columns are kept."""
    entries = F.from_json(F.col(json_col), MapType(StringType(), value_schema))
    exploded = df.select("*", F.explode(entries).alias("key", "entry"))
    return exploded.select(*df.columns, "key", "entry.*")


def flatten_weather(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Current-weather payload to measurement columns; no precipitation means 0.0."""
    parsed = df.withColumn("_payload", F.from_json(F.col(json_col).cast("string"), schemas.WEATHER_PAYLOAD))
    current = "_payload.current."
    return parsed.select(
        *[c for c in df.columns if c != json_col],
        F.col(current + "temperature_2m").alias("temperature_c"),
        F.col(current + "relative_humidity_2m").alias("humidity_pct"),
        F.col(current + "wind_speed_10m").alias("wind_speed_kmh"),
        F.coalesce(F.col(current + "precipitation"), F.lit(0.0)).alias("precipitation_mm"),
    )


def has_reading(json_col: str = "value") -> Column:
    """Whether a current-weather payload can be parsed and holds a reading."""
    return F.from_json(F.col(json_col).cast("string"), schemas.WEATHER_PAYLOAD)["current"].isNotNull()


# RSS items, in the channel or (RSS 1.0) beside it, and Atom entries; an Atom link may be repeated and sits in an attribute.
_RSS_ITEMS = "ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING, `dc:date`: STRING>>"
_FEED = (
    f"channel STRUCT<item: {_RSS_ITEMS}>, item {_RSS_ITEMS}, "
    "entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, published: STRING>>, "
    "_corrupt_record STRING"
)
# Whole items of a document that cannot be read as a whole.
_WHOLE_ITEM = r"(?s)<(item|entry)\b[^>]*>.*?</\1>"


def _items(feed: Column) -> Column:
    """``array<struct<title, link, published>>`` of a parsed feed; null if it has no list of items."""

    def rss(items: Column) -> Column:
        published = lambda i: F.coalesce(i["pubDate"], i["dc:date"])
        return F.transform(items, lambda i: F.struct(i["title"].alias("title"), i["link"].alias("link"), published(i).alias("published")))

    def atom_link(entry: Column) -> Column:
        main = F.filter(entry["link"], lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate"))
        return F.get(main, F.lit(0))["_href"]

    atom = F.transform(
        feed["entry"], lambda e: F.struct(e["title"].alias("title"), atom_link(e).alias("link"), e["published"].alias("published"))
    )
    return F.coalesce(rss(feed["channel"]["item"]), rss(feed["item"]), atom)


def _read_feeds(df: DataFrame, xml_col: str, source_col: str) -> DataFrame:
    """``source``, the other columns, ``_list`` of items and the ``_reason`` why a document could not be read as a whole."""
    others = [c for c in df.columns if c not in (xml_col, source_col)]
    parsed = df.select(F.col(source_col).alias("source"), *others, F.col(xml_col).alias("_xml"), F.from_xml(F.col(xml_col), _FEED).alias("_f"))
    broken = F.col("_f._corrupt_record").isNotNull()
    # A cut feed still gives its whole items; the list of pieces is empty where a document is whole.
    pieces = F.when(broken, F.array_join(F.regexp_extract_all("_xml", F.lit(_WHOLE_ITEM), F.lit(0)), ""))
    saved = F.from_xml(F.concat(F.lit("<rss>"), pieces, F.lit("</rss>")), _FEED)
    parsed = parsed.select("source", *others, "_xml", "_f", broken.alias("_broken"), saved.alias("_saved"))
    reason = (
        F.when(F.trim(F.coalesce("_xml", F.lit(""))) == "", "empty")
        .when(F.col("_broken"), "unreadable")
        .when(_items(F.col("_f")).isNull() & F.col("_f.channel").isNull(), "no feed")
    )
    items = F.when(F.col("_broken"), _items(F.col("_saved"))).otherwise(_items(F.col("_f")))
    return parsed.select("source", *others, items.alias("_list"), reason.alias("_reason"))


def parse_feed_items(df: DataFrame, xml_col: str, source_col: str = "source") -> DataFrame:
    """Feed documents (RSS 2.0 or 1.0, Atom) to ``(source, position, title, link, published)``, feed order kept.

    Missing fields are empty text. Of a document that is cut or broken the whole items are read; it is also one
    of :func:`rejected_feeds`. Items of one document are exploded where the document is parsed, so nothing is shuffled.
    """
    others = [c for c in df.columns if c not in (xml_col, source_col)]
    items = _read_feeds(df, xml_col, source_col).select("source", *others, F.posexplode("_list").alias("position", "i"))
    return items.select(
        "source",
        *others,
        "position",
        *[F.coalesce(F.col(f"i.{c}"), F.lit("")).alias(c) for c in ("title", "link", "published")],
    )


def rejected_feeds(df: DataFrame, xml_col: str, source_col: str = "source") -> DataFrame:
    """Documents that are no whole feed: ``source``, the other columns, ``reason`` and the number of items ``saved`` from them.

    ``empty``: null or blank; ``unreadable``: cut or no XML; ``no feed``: XML with neither a channel nor items.
    """
    others = [c for c in df.columns if c not in (xml_col, source_col)]
    read = _read_feeds(df, xml_col, source_col).where(F.col("_reason").isNotNull())
    return read.select("source", *others, F.col("_reason").alias("reason"), F.coalesce(F.array_size("_list"), F.lit(0)).alias("saved"))
