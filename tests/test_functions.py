import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from epilink.functions import (
    alert_sentence,
    clamp_to_zero,
    content_hash,
    current_week_key,
    epi_week,
    epi_year,
    epoch_seconds_now,
    extract_temporal_key,
    float_text,
    gazetteer_key,
    iso_text_to_date,
    iso_utc_now,
    local_name,
    mint_iri,
    month_label,
    normalize_name,
    prefixed_id,
    python_round,
    python_strip,
    python_title,
    record_id,
    split_week_key,
    squeeze,
    timex_to_week_key,
    week_key,
    with_defaults,
    with_epi_week_key,
)


def one(spark, value, ddl, fn):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], f"c {ddl}").select(fn(F.col("c"))).collect()]


def week_by_counting(day, pivot):
    """Year and number of a Sunday week by counting the weeks whose pivot day lies in the year."""
    start = day - dt.timedelta(days=(day.weekday() + 1) % 7)
    year = (start + dt.timedelta(days=pivot)).year
    number, week = 0, start
    while (week + dt.timedelta(days=pivot)).year == year:
        number, week = number + 1, week - dt.timedelta(days=7)
    return year, number


@pytest.mark.parametrize("rule,pivot", [("thursday", 4), ("mmwr", 3)])
def test_epi_week_matches_counting(spark, rule, pivot):
    days = [dt.date(1990, 1, 1) + dt.timedelta(days=i) for i in range(0, 18_628)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", epi_year(F.col("d"), rule), epi_week(F.col("d"), rule)).collect()
    assert all(week_by_counting(d, pivot) == (y, w) for d, y, w in got)


def test_epi_week_known_day(spark):
    assert one(spark, [dt.date(2026, 6, 30)], "date", week_key) == ["2026-W27"]
    assert one(spark, [dt.date(2026, 6, 30)], "date", lambda c: week_key(c, "mmwr")) == ["2026-W26"]


def test_week_key_pads_and_keeps_nulls(spark):
    df = spark.createDataFrame([(2026, 7), (None, 7), (2026, None), (2026, 27)], "epi_year int, epi_week int")
    assert [r.epi_week_key for r in with_epi_week_key(df).collect()] == ["2026-W07", None, None, "2026-W27"]


def test_split_week_key(spark):
    df = spark.createDataFrame([("2026-W27",), ("2026",), (None,), ("x-Wy",)], "epi_week_key string")
    assert [tuple(r)[1:] for r in split_week_key(df).collect()] == [(2026, 27), (2026, None), (None, None), (None, None)]


def test_iso_text_to_date(spark):
    texts = [
        "2024-07-25",
        "2024-07-25T23:30:00+05:00",
        "2024-07-25T00:30:00Z",
        "2024-07-25T10:15:00.123456+00:00",
        "2024-02-31",
        "25/07/2024",
        "2024-07-25T25:00:00",
        "2024-07-25 10:00",
        "",
        None,
    ]
    day = dt.date(2024, 7, 25)
    assert one(spark, texts, "string", iso_text_to_date) == [day] * 4 + [None] * 6


def test_timex_to_week_key(spark):
    values = ["2024-W99", "2024-07-25", "2024-07", "2024-07-25T10:00", "PRESENT_REF", "2024-02-31", None, ""]
    assert one(spark, values, "string", timex_to_week_key) == ["2024-W99", "2024-W30"] + [None] * 6


def test_extract_temporal_key(spark):
    texts = [
        "Flash floods reported in Dera Ghazi Khan on 25 July 2024 following heavy upstream rainfall.",
        "Flood reported in D.G Khan on 30 June 2026; severity moderate.",
        "On July 25, 2024 and again on 1 January 2020.",
        "the 3rd of Sept 2023, no more",
        "Not on 2024-02-31 but on 2024-07-25.",
        "seen 2024-07-25T10:00 only",
        "week 2024-W30 it was",
        "Last week's monsoon rains triggered landslide alerts.",
        "31 February 2024 only",
        "May 2024 only",
        "",
        None,
        "word " * 5000 + "on 25 July 2024.",
    ]
    got = one(spark, texts, "string", extract_temporal_key)
    assert got == [
        "2024-W30", "2026-W27", "2024-W30", "2023-W36", "2024-W30", None, "2024-W30", None, None, None, None, None, "2024-W30",
    ]
    assert one(spark, ["none"], "string", lambda c: extract_temporal_key(c, F.lit("2026-W01"))) == ["2026-W01"]


def test_now_functions(spark):
    row = spark.range(1).select(
        iso_utc_now().alias("iso"), epoch_seconds_now().alias("s"), current_week_key().alias("k")
    ).first()
    stamp = dt.datetime.fromisoformat(row.iso)
    assert stamp.utcoffset() == dt.timedelta(0)
    assert abs(stamp.timestamp() - row.s) < 5
    year, week = week_by_counting(stamp.date(), 4)
    assert row.k == f"{year}-W{week:02d}"


def test_sentence_and_month(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 6, 30, 1),)], "t timestamp")
    row = df.select(
        alert_sentence(F.lit("flood"), F.lit("D.G Khan"), F.col("t"), F.lit("moderate")), month_label(F.col("t"))
    ).first()
    assert tuple(row) == ("Flood reported in D.G Khan on 30 June 2026; severity moderate.", "2026-06")


NAMES = [
    "D.G Khan", "  d.g   khan ", "o'neil-SMITH", "R. Y Khan", "", "...", " Lahore City\t", "éCOLE d'été",
    "mb_din,x", "ab1cd 2EF", "\x1fkarachi\x1c", "İzmir", "straße", "ابcd", "a.b-c_d,e",
]


def test_text_follows_python(spark):
    import re

    def normalised(s):
        return re.sub(r"\s+", " ", re.sub(r"[.\-_,]", " ", s.lower().strip())).strip()

    assert one(spark, NAMES, "string", normalize_name) == [normalised(n) for n in NAMES]
    assert one(spark, NAMES, "string", python_strip) == [n.strip() for n in NAMES]
    assert one(spark, NAMES, "string", lambda c: python_title(python_strip(c))) == [n.strip().title() for n in NAMES]
    assert one(spark, ["d g khan", None], "string", squeeze) == ["dgkhan", None]


def test_keys_and_terms(spark):
    assert one(spark, [" Lahore "], "string", lambda c: gazetteer_key(c, F.lit("Pakistan"))) == ["lahore|pakistan"]
    minted = one(spark, ["Indus Waters & More"], "string", lambda c: mint_iri("http://x/", "policy", c))
    assert minted == ["http://x/policy/Indus_Waters_&_More"]
    assert one(spark, ["http://x/a/b", "plain", "1/2"], "string", local_name) == ["b", "plain", "2"]


def test_float_text_follows_python(spark):
    values = [0.0, -0.0, 34.6, 40.0, 1e7, 12345678.9, 1e15, 9999999999999998.0, 1e16, 1.5e-5, 0.0001, 0.00012, -2.5e-7, 1e300]
    assert one(spark, values, "double", float_text) == [repr(v) for v in values]
    assert one(spark, [float("inf"), float("nan"), None], "double", float_text) == ["inf", "nan", None]


def test_python_round_follows_python(spark):
    ratios = [s / a for a in range(1, 260) for s in range(a + 1)]
    ratios += [(2 * k + 1) / 2000 for k in range(1000)] + [random.Random(1).random() for _ in range(5000)]
    assert one(spark, ratios, "double", python_round) == [round(r, 3) for r in ratios]
    assert one(spark, [-0.0015, 12.3456, None], "double", lambda c: python_round(c, 2)) == [round(-0.0015, 2), 12.35, None]


def test_clamp_and_defaults(spark):
    assert one(spark, ["-3", "2.9", "x", None], "string", lambda c: clamp_to_zero(c.try_cast("double"))) == [0, 2, None, None]
    df = spark.createDataFrame([(None, 1.0), ("a", None)], "t string, p double")
    assert [tuple(r) for r in with_defaults(df, {"t": "", "p": 0.0}).collect()] == [("", 1.0), ("a", 0.0)]


def test_ids(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "~")], "x string, y string")
    hashes = [r[0] for r in df.select(content_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == 3
    assert hashes == [r[0] for r in df.select(record_id(["x", "y"])).collect()]
    ids = [r[0] for r in df.select(prefixed_id(["x", "y"], "NDMA-")).collect()]
    assert ids == ["NDMA-" + h[:8].upper() for h in hashes]
    assert df.select(record_id().alias("u")).distinct().count() == 3


def test_relative_keys_are_those_of_the_calendar(spark):
    """Every phrase from every day of three weeks over a new year."""
    from epilink.functions.temporal import extract_relative_key

    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    days = [dt.date(2025, 12, 20) + dt.timedelta(i) for i in range(21)]

    def named(day):
        out = {"today": 0, "Yesterday": -1, "TOMORROW": 1, "last week": -7, "past  week": -7, "this week": 0, "next week": 7}
        out |= {"two days ago": -2, "a week ago": -7, "an  unseen day ago": None, "10 days ago": -10, "twelve weeks ago": -84}
        for k, name in enumerate(names):
            gap = (day.weekday() - k) % 7
            out |= {f"on {name.title()}": -gap, f"last {name}": -(gap or 7), f"next {name}": 7 - gap, f"this {name}": k - day.weekday()}
        return out

    rows = [(d, phrase, n) for d in days for phrase, n in named(d).items()]
    df = spark.createDataFrame([(d, f"It rained ({phrase}), they said.") for d, phrase, _ in rows], "d date, t string")
    got = df.select(extract_relative_key(F.col("t"), F.col("d")), "d", "t").collect()
    moved = spark.createDataFrame([(d + dt.timedelta(n) if n is not None else None, d, f"It rained ({p}), they said.") for d, p, n in rows], "m date, d date, t string")
    want = {(r.d, r.t): r.k for r in moved.select(week_key(F.col("m")).alias("k"), "d", "t").collect()}
    assert {(r[1], r[2]): r[0] for r in got} == want


def test_relative_keys_beside_dates(spark):
    from epilink.functions.temporal import extract_relative_key

    day = F.lit(dt.date(2026, 7, 15))
    key = lambda c: extract_relative_key(c, day, F.lit("none"))
    texts = ["On 2026-06-30, not yesterday", "yesterday, not 2026-06-30", "2024-02-31 or last week", "Sundays and mondayish", "", None, "3 weeks", "yesterdays 2026-W03"]
    assert one(spark, texts, "string", key) == ["2026-W27", "2026-W29", "2026-W28", "none", "none", "none", "none", "2026-W03"]
    assert one(spark, ["last week"], "string", lambda c: extract_relative_key(c, F.lit(None).cast("date"))) == [None]
