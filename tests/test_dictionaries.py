"""Stored dictionaries, and feeds that cannot be read as a whole."""

import json

import pytest
from pyspark.sql import functions as F

from epilink.__main__ import main
from epilink.sinks import batches, read_dictionary, update_dictionary, write_dictionary, write_json_map
from epilink.sources import parse_feed_items, read_json_map, rejected_feeds


def entries(spark, rows):
    return spark.createDataFrame(rows, "key string, lat double, lon double")


def test_update_and_export(spark, tmp_path, rows):
    store = f"{tmp_path}/store"
    update_dictionary(entries(spark, [("a", 1.0, 1.0), ("b", 2.0, 2.0)]), store)
    update_dictionary(entries(spark, [("b", 9.0, 9.0), ("c", 3.0, None)]), store)
    update_dictionary(entries(spark, [("d", 4.0, 4.0), ("d", 5.0, 5.0)]).withColumns({"seq": F.col("lat"), "note": F.lit("x")}), store, order_by="seq")
    want = [("a", 1.0, 1.0), ("b", 9.0, 9.0), ("c", 3.0, None), ("d", 5.0, 5.0)]
    assert rows(read_dictionary(spark, store)) == want and read_dictionary(spark, store).columns == ["key", "lat", "lon"]
    path = write_json_map(read_dictionary(spark, store), f"{tmp_path}/out")
    assert rows(read_json_map(spark, path), "key", "lat", "lon") == want
    (text,) = [r.value for r in spark.read.text(path).collect()]
    assert list(json.loads(text)) == ["a", "b", "c", "d"] and json.loads(text)["b"] == {"lat": 9.0, "lon": 9.0}


def test_a_crash_before_the_switch_leaves_the_old_version(spark, tmp_path, rows, monkeypatch):
    store = f"{tmp_path}/store"
    write_dictionary(entries(spark, [("a", 1.0, 1.0)]), store)

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(batches, "commit", lost)
    with pytest.raises(OSError):
        update_dictionary(entries(spark, [("a", 2.0, 2.0)]), store)
    monkeypatch.undo()
    assert rows(read_dictionary(spark, store)) == [("a", 1.0, 1.0)]
    before = read_dictionary(spark, store)
    update_dictionary(entries(spark, [("a", 3.0, 3.0)]), store)
    # Whoever began to read the old version goes on with it until it is cleaned up.
    assert rows(before) == [("a", 1.0, 1.0)] and rows(read_dictionary(spark, store)) == [("a", 3.0, 3.0)]
    assert batches.clean_up(spark, store) == []
    assert len(batches.clean_up(spark, store, older_than_seconds=-5)) == 3
    assert rows(read_dictionary(spark, store)) == [("a", 3.0, 3.0)]


def test_empty_dictionaries(spark, tmp_path, rows):
    store = f"{tmp_path}/store"
    none = entries(spark, [])
    assert read_dictionary(spark, store, none.schema).count() == 0
    update_dictionary(none, store)
    update_dictionary(entries(spark, [("a", 1.0, None)]), store)
    assert rows(read_dictionary(spark, store)) == [("a", 1.0, None)]
    assert spark.read.text(write_json_map(none, f"{tmp_path}/out")).first().value == "{}"


def test_dictionary_by_command_line(spark, tmp_path, capsys):
    for i, text in enumerate(('{"x|y": {"lat": 1.0, "lon": 2.0}}', '{"x|y": {"lat": 3.0, "lon": 2.0}, "z|y": {"lat": 1.5, "lon": 2.0, "display_name": "Z"}}')):
        (tmp_path / f"{i}.json").write_text(text)
        main(["dictionary", "--store", f"{tmp_path}/store", "--add", f"{tmp_path}/{i}.json", "--export", f"{tmp_path}/all"])
    assert "2 entries" in capsys.readouterr().out
    found = json.loads(spark.read.text(f"{tmp_path}/all").first().value)
    assert found == {"x|y": {"lat": 3.0, "lon": 2.0}, "z|y": {"lat": 1.5, "lon": 2.0, "display_name": "Z"}}


RSS1 = '<?xml version="1.0"?><rdf:RDF xmlns:rdf="r" xmlns="n" xmlns:dc="d"><channel rdf:about="u"><title>c</title></channel>' + "".join(
    f'<item rdf:about="{i}"><title>t{i}</title><link>l{i}</link><dc:date>2026-0{i}</dc:date></item>' for i in (1, 2)
) + "</rdf:RDF>"
ITEM = "<item><title>{0}</title><link>l{0}</link><pubDate>p{0}</pubDate></item>"
FEEDS = {
    "whole": ("<rss><channel>" + ITEM.format(1) + "</channel></rss>", [("1", "l1", "p1")], None),
    "rss1": (RSS1, [("t1", "l1", "2026-01"), ("t2", "l2", "2026-02")], None),
    "rss1 cut": (RSS1[:-30], [("t1", "l1", "2026-01")], ("unreadable", 1)),
    "cut": ("<rss><channel>" + ITEM.format(1) + ITEM.format("a &amp; b") + "<item><title>x", [("1", "l1", "p1"), ("a & b", "la & b", "pa & b")], ("unreadable", 2)),
    "atom cut": ('<feed><entry><title>t</title><link href="h"/></entry><entry>', [("t", "h", "")], ("unreadable", 1)),
    "text": ("gone & away", [], ("unreadable", 0)),
    "html": ("<html><body/></html>", [], ("no feed", 0)),
    "blank": ("  ", [], ("empty", 0)),
    "null": (None, [], ("empty", 0)),
    "without items": ("<rss><channel><title>c</title></channel></rss>", [], None),
}


def test_feeds_leave_a_trace(spark):
    df = spark.createDataFrame([(name, text) for name, (text, *_) in FEEDS.items()], "source string, xml string")
    read = parse_feed_items(df, "xml").orderBy("source", "position").collect()
    rejected = {r.source: (r.reason, r.saved) for r in rejected_feeds(df, "xml").collect()}
    for name, (_, items, reason) in FEEDS.items():
        assert [(r.title, r.link, r.published) for r in read if r.source == name] == items, name
        assert rejected.get(name) == reason, name
