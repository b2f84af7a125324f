import datetime as dt
import json

from pyspark.sql import functions as F

from epilink import schemas, vocabulary
from epilink.__main__ import main
from epilink.plans import ingest, jobs
from epilink.session import scratch_path, settle, shared_folder
from epilink.sources import parse_json
from epilink.sinks import to_messages

DAY = dt.date(2026, 6, 30)


def test_surveillance_records(spark):
    raw = spark.createDataFrame([("D.G Khan", "ili", 30, 74.5)], "district string, disease string, case_count int, idsr_compliance_pct double")
    row = ingest.surveillance_records(raw, F.lit(DAY)).first()
    assert (row.district_canonical, row.province, row.lat, row.epi_year, row.epi_week, row.source) == (
        "Dera Ghazi Khan", "Punjab", 30.0321374, 2026, 27, "NIH_PAKISTAN"
    )
    assert row.record_id == ingest.surveillance_records(raw, F.lit(DAY)).first().record_id


def test_weather_records(spark):
    raw = spark.createDataFrame([("Lahore", '{"current": {"temperature_2m": 31.3}}')], "district string, value string")
    row = ingest.weather_records(raw, day=F.lit(DAY)).first()
    assert (row.temperature_c, row.precipitation_mm, row.epi_week, row.source, row.lon) == (31.3, 0.0, 27, "PMD", 74.3436)
    assert abs(row.timestamp - dt.datetime.now().timestamp()) < 60


def test_alert_records(spark):
    issued = F.lit(dt.datetime(2026, 6, 30, 12))
    raw = spark.createDataFrame(
        [("D.G Khan", "flood", "moderate", None), ("Quetta", "drought", "minor", "Dry since 25 July 2024."), ("X", "flood", "minor", "no date")],
        "district string, event_type string, severity string, description string",
    )
    got = {r.district: r for r in ingest.alert_records(raw, issued).collect()}
    assert got["D.G Khan"].description == "Flood reported in D.G Khan on 30 June 2026; severity moderate."
    assert [got[d].extracted_temporal_key for d in ("D.G Khan", "Quetta", "X")] == ["2026-W27", "2024-W30", "2026-W27"]
    assert got["X"].alert_id.startswith("NDMA-") and len(got["X"].alert_id) == 13
    assert got["X"].issued_at == "2026-06-30T12:00:00.000000+00:00"


def test_policy_and_news_records(spark):
    raw = spark.createDataFrame(
        [("T", "Water Policy", "Draft", 2026, "S", ["Water"])],
        "title string, policy_type string, status string, year int, summary string, sectors array<string>",
    )
    row = ingest.policy_records(raw, F.lit(dt.datetime(2026, 6, 30))).first()
    assert (row.report_month, row.report_year, row.report_month_label, row.sectors) == (6, 2026, "2026-06", ["Water"])
    items = "".join(f"<item><title>t{i}</title></item>" for i in range(9))
    feeds = spark.createDataFrame([("A", f"<rss><channel>{items}</channel></rss>")], "source string, value string")
    news = ingest.news_records(feeds, "value")
    assert [r.title for r in news.collect()] == ["t0", "t1", "t2", "t3", "t4"]
    assert news.first().link == ""


def test_pipeline_by_command_line(spark, tmp_path, capsys):
    """Raw tables to topics, topics to tables, tables to link, graph and summaries."""
    raw, topics, base, log = (f"{tmp_path}/{d}" for d in ("raw", "topics", "base", "log"))
    spark.createDataFrame(
        [(d, x, n, 80.0) for d in ("Lahore", "D.G Khan") for x, n in (("ili", 40), ("dengue", 9))],
        "district string, disease string, case_count int, idsr_compliance_pct double",
    ).write.parquet(f"{raw}/surveillance")
    spark.createDataFrame(
        [("Lahore", '{"current": {"temperature_2m": 31.5, "relative_humidity_2m": 68.0}}'), ("D.G Khan", None), ("Karachi", "{broken")], "district string, value string"
    ).write.parquet(f"{raw}/weather")
    spark.createDataFrame([("Lahore", "flood", "severe")], "district string, event_type string, severity string").write.parquet(f"{raw}/alerts")
    spark.createDataFrame(
        [("Plan A", "Water Policy", "Draft", 2026, "S", ["Water"])],
        "title string, policy_type string, status string, year int, summary string, sectors array<string>",
    ).write.parquet(f"{raw}/policy")
    spark.createDataFrame([("F", "<rss><channel>" + "<item><title>t</title></item>" * 7 + "</channel></rss>")], "source string, value string").write.parquet(f"{raw}/news")

    for kind in vocabulary.TOPICS:
        main(["publish", kind, "--input", f"{raw}/{kind}", "--folder", topics, "--metrics-log", log])
    main(["harmonize", "--base", base, "--checkpoints", f"{tmp_path}/ckpt", "--folder", topics, "--available-now"])
    main(["link", "--base", base])
    linked = spark.read.parquet(f"{base}/{jobs.LINKED_FOLDER}")
    assert linked.count() == 4
    assert {(r.district_canonical, r.avg_temperature_c, r.has_concurrent_disaster) for r in linked.collect()} == {
        ("Lahore", 31.5, True), ("Dera Ghazi Khan", None, False)
    }
    assert {"epi_week_key", "processed_at", "idsr_compliance_pct", "event_types"} <= set(linked.columns)

    capsys.readouterr()
    main(["metrics", "--log", log])
    shown = capsys.readouterr().out
    assert "NIH" in shown and "RSS/Media" in shown
    assert {(r.source, r.records_attempted, r.records_succeeded) for r in spark.read.schema(schemas.METRICS).json(log).collect()} == {
        ("NIH", 4, 4), ("WEATHER", 3, 1), ("NDMA", 1, 1), ("Policy", 1, 1), ("RSS/Media", 5, 5)
    }

    main(["graph", "--base", base, "--out", f"{tmp_path}/kg"])
    # types 2+2+1+1, hasDisease 4, caseCount 4, temperature 1, humidity 1, hasDisaster 1, severity 1, title 1, status 1
    assert "20 triples" in capsys.readouterr().out
    main(["policies", "--graph", f"{tmp_path}/kg/knowledge_graph.nt"])
    assert "Plan_A" in capsys.readouterr().out
    main(["property-graph", "--graph", f"{tmp_path}/kg/knowledge_graph.nt", "--out", f"{tmp_path}/pg"])
    assert spark.read.parquet(f"{tmp_path}/pg/edges").count() == 5
    main(["edges", "--graph", f"{tmp_path}/kg/knowledge_graph.nt", "--out", f"{tmp_path}/edges"])
    assert spark.read.parquet(f"{tmp_path}/edges").where("src = 'Plan_A'").count() == 3
    main(["summaries", "--base", base, "--out", f"{tmp_path}/sum"])
    assert {r.cases for r in spark.read.parquet(f"{tmp_path}/sum/cases").collect()} == {49}


def test_publish_with_own_dictionaries(spark, tmp_path):
    raw, topics = f"{tmp_path}/raw", f"{tmp_path}/topics"
    spark.createDataFrame([("old town",), ("Elsewhere",), ("Lahore",)], "district string").selectExpr(
        "district", "'ili' AS disease", "1 AS case_count", "1.0D AS idsr_compliance_pct"
    ).write.parquet(raw)
    spark.createDataFrame([("old town", "Newtown", "North", 0)], "alias string, canonical string, province string, rank int").write.parquet(f"{tmp_path}/aliases")
    spark.createDataFrame([("elsewhere", 3.0, 4.0)], "name string, lat double, lon double").write.parquet(f"{tmp_path}/fallback")
    (tmp_path / "gazetteer.json").write_text('{"newtown|pakistan": {"lat": 1.0, "lon": 2.0}}')
    main(
        ["publish", "surveillance", "--input", raw, "--folder", topics, "--metrics-log", f"{tmp_path}/log", "--aliases", f"{tmp_path}/aliases"]
        + ["--gazetteer", f"{tmp_path}/gazetteer.json", "--fallback", f"{tmp_path}/fallback"]
    )
    sent = parse_json(spark.read.text(f"{topics}/{vocabulary.TOPICS['surveillance']}"), schemas.SURVEILLANCE)
    assert {(r.district, r.district_canonical, r.province, r.lat, r.lon) for r in sent.collect()} == {
        ("old town", "Newtown", "North", 1.0, 2.0), ("Elsewhere", "Elsewhere", "UNKNOWN", 3.0, 4.0), ("Lahore", "Lahore", "UNKNOWN", None, None)
    }


def test_link_needs_cases_and_weather(spark, tmp_path):
    assert jobs.link_job(spark, str(tmp_path)) is None


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert settle(spark.range(5)).count() == 5


def test_message_schemas_survive_json(spark):
    for kind, schema in schemas.MESSAGES.items():
        empty = spark.createDataFrame([tuple([None] * len(schema))], schema)
        assert parse_json(to_messages(empty), schema).schema == schema, kind
        assert json.loads(to_messages(empty).first().value) == {f.name: None for f in schema}
