import random

import pytest
from pyspark.sql import functions as F

from epilink import schemas
from epilink.operators.aggregates import summaries
from epilink.operators.link import can_link, link_sources, weekly_alerts, weekly_means
from epilink.operators.lookup import left_lookup, measured_bytes
from epilink.operators.topn import linked_sample, top_n_per

CASES = "record_id string, district_canonical string, epi_week_key string, disease string, case_count int"
WEATHER = (
    "district_canonical string, epi_week_key string, temperature_c double, humidity_pct double, "
    "precipitation_mm double, wind_speed_kmh double"
)
ALERTS = "district_canonical string, epi_week_key string, alert_id string, severity string, event_type string"


@pytest.fixture(scope="module")
def tables(spark):
    cases = [
        ("1", "Lahore", "2026-W27", "dengue", 9),
        ("2", "Lahore", "2026-W27", "ili", 40),
        ("3", "Lahore", "2026-W28", "ili", 5),
        ("4", "Quetta", "2026-W27", "ili", 7),
        ("5", None, "2026-W27", "ili", 1),
        ("6", "Quetta", None, "ili", 2),
    ]
    weather = [
        ("Lahore", "2026-W27", 30.0, 60.0, 0.0, 10.0),
        ("Lahore", "2026-W27", 32.0, None, 1.0, float("nan")),
        ("Quetta", "2026-W27", 20.0, 30.0, 0.0, 5.0),
        (None, "2026-W27", 99.0, 99.0, 9.0, 9.0),
        ("Multan", "2026-W27", 41.0, 20.0, 0.0, 3.0),
    ]
    alerts = [
        ("Lahore", "2026-W27", "a1", "severe", "flood"),
        ("Lahore", "2026-W27", "a2", "minor", "heatwave"),
        ("Lahore", "2026-W27", "a3", "minor", "flood"),
        ("Lahore", "2026-W27", "a4", "severe", "flood"),
        ("Lahore", "2026-W28", None, None, "drought"),
        ("Quetta", None, "a5", "severe", "flood"),
    ]
    return (
        spark.createDataFrame(cases, CASES),
        spark.createDataFrame(weather, WEATHER),
        spark.createDataFrame(alerts, ALERTS),
    )


ADDED = [
    "record_id", "avg_temperature_c", "avg_humidity_pct", "avg_precipitation_mm", "avg_wind_speed_kmh",
    "disaster_event_count", "max_severity", "event_types", "has_concurrent_disaster",
]
LINKED = [
    ("1", 31.0, 60.0, 0.5, 10.0, 4, "minor", "flood, heatwave", True),
    ("2", 31.0, 60.0, 0.5, 10.0, 4, "minor", "flood, heatwave", True),
    ("3", None, None, None, None, 0, None, "drought", False),
    ("4", 20.0, 30.0, 0.0, 5.0, None, None, None, False),
    ("5", None, None, None, None, None, None, None, False),
    ("6", None, None, None, None, None, None, None, False),
]


@pytest.mark.parametrize("limit_bytes", [64 << 20, -1])
def test_link_small_and_large_context(tables, rows, limit_bytes):
    linked = link_sources(*tables, limit_bytes=limit_bytes)
    assert rows(linked, *ADDED) == LINKED
    assert linked.columns[:5] == tables[0].columns


def test_severity_by_rank(tables, rows):
    got = weekly_alerts(tables[2], severity="rank")
    assert rows(got, "epi_week_key", "max_severity") == [("2026-W27", "severe"), ("2026-W28", None)]
    with pytest.raises(ValueError):
        weekly_alerts(tables[2], severity="worst")


def test_link_without_alerts(spark, tables, rows):
    none = spark.createDataFrame([], schemas.harmonised("alerts"))
    linked = link_sources(tables[0], tables[1], none)
    assert set(rows(linked, "disaster_event_count", "event_types", "has_concurrent_disaster")) == {(None, None, False)}
    assert can_link(tables[0], tables[1])
    assert not can_link(tables[0], tables[1].limit(0))


def test_link_of_chosen_weeks(tables, rows):
    linked = link_sources(*tables, weeks=("2026-W28", "2026-W30"))
    assert rows(linked, "record_id") == [("3",)]


def test_alerts_match_brute_force(spark):
    rnd = random.Random(3)
    pick = lambda values: rnd.choice(values)
    data = [
        (pick("AB"), pick(["w1", "w2", None]), pick(["x", None]), pick(["minor", "severe", "moderate", None]), pick(["f", "d", None]))
        for _ in range(400)
    ]
    groups = {}
    for place, week, alert, severity, kind in data:
        if week is not None:
            groups.setdefault((place, week), []).append((alert, severity, kind))
    want = set()
    for key, members in groups.items():
        severities = [s for _, s, _ in members if s]
        mode = min(set(severities), key=lambda s: (-severities.count(s), s)) if severities else None
        kinds = ", ".join(sorted({k for *_, k in members if k})) or None
        want.add((*key, sum(a is not None for a, *_ in members), mode, kinds))
    got = weekly_alerts(spark.createDataFrame(data, ALERTS))
    assert {tuple(r) for r in got.collect()} == want


def test_hot_place_keeps_every_row_and_is_split(spark):
    """Most cases in one place and week; beyond the broadcast limit its partition is split."""
    cases = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("record_id"),
        F.when(F.col("id") % 10 < 9, "Hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("district_canonical"),
        F.lit("2026-W27").alias("epi_week_key"),
        F.lit("ili").alias("disease"),
        F.lit(1).alias("case_count"),
    )
    weather = spark.range(500).select(
        F.when(F.col("id") == 0, "Hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("district_canonical"),
        F.lit("2026-W27").alias("epi_week_key"),
        *[F.lit(1.0).alias(c) for c in ("temperature_c", "humidity_pct", "precipitation_mm", "wind_speed_kmh")],
    )
    alerts = spark.createDataFrame([], ALERTS)
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        linked = link_sources(cases, weather, alerts, limit_bytes=-1)
        assert linked.agg(F.count("*"), F.count("avg_temperature_c")).first()[0] == 200_000
        linked.collect()
        plan = linked._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lookup_measures_before_it_broadcasts(spark):
    left = spark.range(10).withColumn("k", F.col("id") % 3)
    right = spark.createDataFrame([(0, "x" * 1000), (1, "y")], "k long, t string")
    assert measured_bytes(right) > 1000
    small = left_lookup(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    large = left_lookup(left, right, ["k"], limit_bytes=500)
    assert "strategy=broadcast" in small
    assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()
    assert large.count() == 10


def test_weekly_means_drop_null_keys(tables, rows):
    assert rows(weekly_means(tables[1]), "district_canonical") == [("Lahore",), ("Multan",), ("Quetta",)]


def test_linked_sample(tables):
    got = linked_sample(link_sources(*tables), 2)
    assert got.count() == 2
    assert got.columns[:4] == ["district_canonical", "epi_week_key", "disease", "case_count"]
    assert "disaster_event_count" not in linked_sample(tables[0], 2).columns


def test_summaries(tables, rows):
    got = summaries(*tables)
    assert [tuple(r) for r in got["cases"].collect()] == [("Lahore", 54), ("Quetta", 9), (None, 1)]
    assert ("Lahore", 31.0) in rows(got["temperature"])
    assert rows(got["alerts"]) == [("Lahore", 5), ("Quetta", 1)]


def test_top_n_cuts_groups_before_the_shuffle(spark, rows):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    top = top_n_per(df, ["g"], ["id"], 3)
    assert rows(top, "id") == [(0,), (1,), (2,), (3,), (4,), (5,)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
