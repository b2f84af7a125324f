import itertools
import re

import pytest
from pyspark.sql import functions as F

from epilink.operators.geo import geocode, resolve_and_geocode
from epilink.operators.names import alias_table, containments, resolve_names


def normalised(s):
    return re.sub(r"\s+", " ", re.sub(r"[.\-_,]", " ", s.lower().strip())).strip()


def expected(name, entries, min_len=0):
    """Direct reading of the rules, one name at a time."""
    if not name:
        return "UNKNOWN", "UNKNOWN", False
    exact, tight = {}, {}
    for alias, canonical, province in entries:
        exact[normalised(alias)] = (canonical, province)
        tight[normalised(alias).replace(" ", "")] = (canonical, province)
    n = normalised(name)
    for table, key in ((exact, n), (tight, n.replace(" ", ""))):
        if key in table:
            return (*table[key], True)
    for alias, place in exact.items():
        if (alias in n and len(alias) >= min_len) or (n in alias and len(n) >= min_len):
            return (*place, True)
    return name.strip().title(), "UNKNOWN", False


ENTRIES = [
    ("ab c", "One", "P"), ("ab-c", "Two", "Q"), ("a b c d", "Three", "P"), ("abcd", "Four", "Q"),
    ("xyz", "Five", "P"), ("yz", "Six", "P"), ("k", "Seven", "P"), ("long name here", "Eight", "P"),
]
NAMES = ["".join(p) for n in range(1, 5) for p in itertools.product("abxk ", repeat=n)]
NAMES += ["The XYZ town", "name", "g", "...", "   ", "", None, "Zürich-Nord", "abcd", "A.B.C.D", "yzx", "o'hara"]


@pytest.mark.parametrize("min_len", [0, 3])
def test_all_steps_match_the_rules(spark, min_len):
    rows = [(a, c, p, i) for i, (a, c, p) in enumerate(ENTRIES)]
    aliases = spark.createDataFrame(rows, "alias string, canonical string, province string, rank int")
    names = spark.createDataFrame([(n,) for n in NAMES], "raw string")
    want = {n: expected(n, ENTRIES, min_len) for n in NAMES}
    got = resolve_names(names, "raw", aliases, min_len=min_len).collect()
    assert len(got) == len(NAMES)
    assert {r.raw: (r.canonical, r.province, r.matched) for r in got} == want


def test_built_in_dictionary(spark):
    names = spark.createDataFrame([("D.G Khan",), ("R. Y Khan",), ("Lahore",), ("Unknown Place",), ("khan",)], "raw string")
    got = {r.raw: (r.canonical, r.province, r.matched) for r in resolve_names(names, "raw").collect()}
    assert got == {
        "D.G Khan": ("Dera Ghazi Khan", "Punjab", True),
        "R. Y Khan": ("Rahim Yar Khan", "Punjab", True),
        "Lahore": ("Lahore", "Punjab", True),
        "Unknown Place": ("Unknown Place", "UNKNOWN", False),
        "khan": ("Dera Ghazi Khan", "Punjab", True),
    }


def test_built_in_dictionary_as_a_table_agrees(spark):
    raws = ["D.G Khan", "rahimyarkhan", "Greater Lahore", "pin", "Nowhere", "", None, "--"]
    names = spark.createDataFrame([(r,) for r in raws], "raw string")
    entries = [tuple(r)[:3] for r in alias_table(spark).orderBy("rank").collect()]
    got = resolve_names(names, "raw", alias_table(spark)).collect()
    assert sorted(map(repr, resolve_names(names, "raw").collect())) == sorted(map(repr, got))
    assert {r.raw: (r.canonical, r.province, r.matched) for r in got} == {n: expected(n, entries) for n in raws}


def test_containment_pairs_are_brute_force(spark):
    import random

    rng = random.Random(5)
    texts = {"".join(rng.choices("abc ", k=rng.randint(0, 9))) for _ in range(150)}
    inner, outer = sorted(texts)[::2], sorted(texts)[1::2] + ["caf\u00e9 \U0001f600 ab", "ab"]
    side = lambda rows: spark.createDataFrame([(t,) for t in rows], "text string")
    got = containments(side(inner + ["\u00e9 \U0001f600", "\U0001f600"]), side(outer)).collect()
    want = {(i, o) for i in inner + ["\u00e9 \U0001f600", "\U0001f600"] for o in outer if i and i in o}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert containments(side([]), side(outer)).count() == containments(side(inner), side([])).count() == 0


def test_pieces_of_texts_are_never_broadcast(spark, tmp_path):
    """The file of the texts is small, whatever number of pieces is made of them."""
    spark.range(300).select(F.concat(F.lit("place "), "id").alias("text")).write.parquet(f"{tmp_path}/texts")
    texts = spark.read.parquet(f"{tmp_path}/texts")
    found = containments(texts.where("text like '%1'"), texts)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == sum(f"place {i}" in f"place {o}" for i in range(1, 300, 10) for o in range(300))


def test_empty_dictionary(spark):
    none = spark.createDataFrame([], "alias string, canonical string, province string, rank int")
    got = resolve_names(spark.createDataFrame([("some town",)], "raw string"), "raw", none).first()
    assert tuple(got) == ("some town", "Some Town", "UNKNOWN", False)


def test_geocode_sources(spark):
    names = spark.createDataFrame([("D.G Khan",), ("Karachi",), ("Pindi",), ("Atlantis",), (None,)], "raw string")
    got = {r.raw: (r.lat, r.lon, r.geocode_source) for r in resolve_and_geocode(names, "raw").collect()}
    assert got["D.G Khan"] == (30.0321374, 70.6401114, "cache")
    assert got["Karachi"] == (24.8607, 67.0011, "cache")
    assert got["Pindi"] == got["Atlantis"] == got[None] == (None, None, "unresolved")


def test_geocode_falls_back_on_the_raw_name(spark):
    names = spark.createDataFrame([(" lahore ", "Somewhere"), ("x", "Known")], "raw string, place string")
    gazetteer = spark.createDataFrame([("known|pakistan", 1.0, 2.0)], "key string, lat double, lon double")
    got = {r.place: (r.lat, r.lon, r.geocode_source) for r in geocode(names, "place", gazetteer, raw_col="raw").collect()}
    assert got == {"Somewhere": (31.5497, 74.3436, "settings_fallback"), "Known": (1.0, 2.0, "cache")}


def test_hot_name_keeps_every_row(spark):
    names = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "Lahore City").otherwise(F.col("id").cast("string")).alias("raw"))
    got = resolve_names(names, "raw", alias_table(spark))
    assert got.count() == 3000
    assert got.where("canonical = 'Lahore'").count() == 1000


def test_geocode_keeps_one_row_per_row_on_repeated_keys(spark):
    listed = spark.createDataFrame([("Here", 2.0, 5.0), ("HERE", 1.0, 9.0)], "name string, lat double, lon double")
    cached = spark.createDataFrame([("there|pakistan", 4.0, 4.0), ("there|pakistan", 3.0, 3.0)], "key string, lat double, lon double")
    rows = spark.createDataFrame([("here",), ("there",)], "place string")
    from epilink.operators.geo import geocode

    found = sorted(tuple(r) for r in geocode(rows, "place", cached, listed).collect())
    assert found == [("here", 1.0, 9.0, "settings_fallback"), ("there", 3.0, 3.0, "cache")]


def test_entries_without_a_coordinate_are_no_entries(spark):
    listed = spark.createDataFrame([("here", None, 5.0), ("here", 2.0, 6.0), ("there", 7.0, None)], "name string, lat double, lon double")
    cached = spark.createDataFrame([("here|pakistan", None, None), ("far|pakistan", 1.0, None), ("far|pakistan", 4.0, 4.0)], "key string, lat double, lon double")
    rows = spark.createDataFrame([("here",), ("there",), ("far",)], "place string")
    found = {r.place: (r.lat, r.lon, r.geocode_source) for r in geocode(rows, "place", cached, listed).collect()}
    assert found == {"here": (2.0, 6.0, "settings_fallback"), "there": (None, None, "unresolved"), "far": (4.0, 4.0, "cache")}
