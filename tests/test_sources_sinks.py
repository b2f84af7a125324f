import json

import pytest
from pyspark.sql import functions as F

from epilink import schemas
from epilink.operators.metrics import ingestion_metrics, metrics_row, observe_ingestion, summarize_metrics
from epilink.sinks import append_metrics, publish, to_messages, upsert_by_key, write_table
from epilink.sources import (
    flatten_weather,
    parse_feed_items,
    parse_json,
    path_exists,
    quarantine_json,
    read_json_map,
    read_metrics,
    read_optional,
    read_table,
    tables,
    union_all,
)


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_json_cases(spark):
    texts = [
        json.dumps({"source": "PMD", "district": "Lahore", "temperature_c": 31.3, "humidity_pct": 68.0, "extra": [1]}),
        json.dumps({"source": None, "epi_week": 7}),
        json.dumps({"source": "PMD", "epi_week": "seven"}),
        '{"source": "PM',
    ]
    got = parse_json(messages(spark, texts), schemas.WEATHER).select("source", "district", "epi_week", "temperature_c")
    assert [tuple(r) for r in got.collect()] == [
        ("PMD", "Lahore", None, 31.3),
        (None, None, 7, None),
        ("PMD", None, None, None),
        (None, None, None, None),
    ]
    binary = messages(spark, texts[:1]).select(F.col("value").cast("binary").alias("value"))
    assert parse_json(binary, schemas.WEATHER).first().source == "PMD"


def test_quarantine(spark, rows):
    good, bad = quarantine_json(messages(spark, ['{"title": "a"}', '{"title": ', "null", "[]"]), schemas.NEWS)
    assert rows(good, "title") == [("a",)]
    assert ('{"title": ',) in rows(bad)
    assert good.count() + bad.count() == 4


def test_message_round_trip_keeps_nulls(spark):
    row = [("r", "s", "t", None, "Draft", 2023, None, ["Water", "Energy"], 6, 2026, "2026-06", "now")]
    df = spark.createDataFrame(row, schemas.POLICY)
    sent = to_messages(df)
    assert '"policy_type":null' in sent.first().value
    assert parse_json(sent, schemas.POLICY).collect() == df.collect()


def test_publish_as_text(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", "c", "d")], schemas.NEWS)
    publish(df, f"{tmp_path}/topic", format="text")
    publish(df, f"{tmp_path}/topic", format="text")
    assert spark.read.text(f"{tmp_path}/topic").count() == 2


def test_weather_payload(spark, rows):
    texts = [
        '{"current": {"temperature_2m": 31.3, "relative_humidity_2m": 68, "wind_speed_10m": 4.5, "precipitation": 0.2}}',
        '{"current": {"temperature_2m": 1.0, "precipitation": null}}',
        "{}",
    ]
    assert [tuple(r) for r in flatten_weather(messages(spark, texts)).collect()] == [
        (31.3, 68.0, 4.5, 0.2), (1.0, None, None, 0.0), (None, None, None, 0.0)
    ]


RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title>
<item><title>First &amp; best</title><link>http://x/1</link><pubDate>Tue, 30 Jun 2026 10:00:00 GMT</pubDate></item>
<item><title><![CDATA[Two <b>]]></title></item><item><link>http://x/3</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>
<entry><title>Entry</title><link rel="self" href="http://x/self"/><link href="http://x/e"/><published>2026-06-30</published></entry></feed>"""


def test_feed_items(spark, rows):
    df = spark.createDataFrame([("A", RSS), ("B", ATOM), ("C", "no xml"), ("D", None)], "source string, xml string")
    assert rows(parse_feed_items(df, "xml")) == [
        ("A", 0, "First & best", "http://x/1", "Tue, 30 Jun 2026 10:00:00 GMT"),
        ("A", 1, "Two <b>", "", ""),
        ("A", 2, "", "http://x/3", ""),
        ("B", 0, "Entry", "http://x/e", "2026-06-30"),
    ]


def test_feed_with_one_item(spark):
    one = "<rss><channel><item><title>t</title><link>l</link><pubDate>d</pubDate></item></channel></rss>"
    df = spark.createDataFrame([("A", one)], "source string, xml string")
    assert [tuple(r) for r in parse_feed_items(df, "xml").collect()] == [("A", 0, "t", "l", "d")]


def test_json_map(spark, tmp_path, rows, monkeypatch):
    path = tmp_path / "cache.json"
    path.write_text(json.dumps({"lahore|pakistan": {"lat": 31.5, "lon": 74.3, "display_name": "Lahore"}, "x|y": {"lat": 1}}, indent=2))
    assert rows(read_json_map(spark, str(path))) == [
        ("lahore|pakistan", 31.5, 74.3, "Lahore"), ("x|y", 1.0, None, None)
    ]


def test_optional_and_recursive_scans(spark, tmp_path, rows):
    base = str(tmp_path)
    assert not path_exists(spark, f"{base}/none")
    empty = read_optional(spark, base, "none", schemas.harmonised("alerts"))
    assert empty.isEmpty() and "epi_week_key" in empty.columns
    df = spark.range(20).select("id", F.concat(F.lit("2026-W"), (F.col("id") % 3 + 10)).alias("epi_week_key"))
    write_table(df, f"{base}/t", "epi_week_key")
    assert read_table(spark, base, "t").count() == 20
    assert dict(read_table(spark, base, "t").dtypes)["epi_week_key"] == "string"
    flat = read_table(spark, base, "t", recursive=True)
    assert flat.columns == ["id"] and flat.count() == 20
    pruned = read_table(spark, base, "t").where("epi_week_key = '2026-W10'")
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString()


def test_union_all(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y",)], "b string")
    assert rows(union_all([a, b])) == [(1, "x"), (None, "y")]


def test_upsert(spark, rows):
    old = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "key string, v int, seq int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "key string, v int, seq int")
    assert rows(upsert_by_key(old, new, "key", "seq"), "key", "v") == [("a", 1), ("b", 4), ("c", 5)]
    assert upsert_by_key(old, new.limit(0), "key").count() == 2


def test_metrics_log(spark, tmp_path, rows):
    log = f"{tmp_path}/log"
    append_metrics(metrics_row(spark, "NIH", 28, 28), log)
    append_metrics(metrics_row(spark, "NIH", 28, 27, ["timeout"]), log)
    append_metrics(metrics_row(spark, "WEATHER", 0, 0), log)
    got = read_metrics(spark, log)
    assert rows(got, "source", "records_failed", "success_rate", "errors") == [
        ("NIH", 0, 1.0, []), ("NIH", 1, 0.964, ["timeout"]), ("WEATHER", 0, 0.0, [])
    ]
    assert rows(summarize_metrics(got)) == [("NIH", 2, 56, 55), ("WEATHER", 1, 0, 0)]


def test_ingestion_metrics(spark, rows):
    df = spark.createDataFrame([("A", 1), ("A", None), ("B", 2), ("A", 3)], "source string, v int")
    got = ingestion_metrics(df, F.col("v") > 1, error=F.lit("small"))
    assert rows(got, "source", "records_attempted", "records_succeeded", "success_rate", "errors") == [
        ("A", 3, 1, 0.333, ["small"]), ("B", 1, 1, 1.0, [])
    ]
    assert rows(ingestion_metrics(df), "source", "records_failed", "errors") == [("A", 0, []), ("B", 0, [])]


def test_observed_counts(spark, tmp_path):
    counted, seen = observe_ingestion(spark.range(10), "run", F.col("id") > 3)
    write_table(counted, f"{tmp_path}/t")
    assert seen.get == {"records_attempted": 10, "records_succeeded": 6}


def test_absent_log_and_dictionary_are_empty(spark, tmp_path):
    from epilink.sources import tables

    assert tables.read_metrics(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_json_map(spark, str(tmp_path / "none.json")).count() == 0
