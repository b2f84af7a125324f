import json

import pytest
from pyspark.sql import functions as F

from epilink import schemas, vocabulary
from epilink.plans.catalog import QUERIES
from epilink.sources import read_topic
from epilink.streaming import default_sources, harmonize, harmonize_stream, run_all


def put(folder, kind, lines, name="a.txt"):
    topic = folder / vocabulary.TOPICS[kind]
    topic.mkdir(parents=True, exist_ok=True)
    (topic / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


@pytest.fixture
def sources(tmp_path):
    topics = tmp_path / "topics"
    put(topics, "surveillance", [{"record_id": "1", "epi_year": 2026, "epi_week": 7, "disease": "ili"}, "{broken"])
    put(topics, "weather", [{"district": "Lahore", "epi_year": 2026, "epi_week": 27, "temperature_c": 31.3}])
    put(topics, "alerts", [{"alert_id": "NDMA-1", "epi_year": 2026, "epi_week": 27, "extracted_temporal_key": "2026-W26"}])
    put(topics, "policy", [{"title": "P", "report_month_label": "2026-06", "sectors": ["Water", "Health"]}])
    put(topics, "news", [{"source": "F", "title": "t", "link": "l", "published": "p"}])
    return tmp_path, default_sources(f"{tmp_path}/base", f"{tmp_path}/ckpt", folder=str(topics))


def test_five_sources_and_restart(spark, sources, rows):
    folder, configs = sources
    run_all(spark, configs, available_now=True)
    table = lambda kind: spark.read.parquet(f"{folder}/base/{vocabulary.TABLE_FOLDERS[kind]}")
    assert rows(table("surveillance"), "record_id", "epi_week_key") == [("1", "2026-W07"), (None, None)]
    assert rows(table("weather"), "temperature_c", "epi_week_key") == [(31.3, "2026-W27")]
    assert rows(table("alerts"), "alert_id", "extracted_temporal_key") == [("NDMA-1", "2026-W26")]
    assert rows(table("policy"), "title", "report_month_label", "sectors") == [("P", "2026-06", ["Water", "Health"])]
    assert rows(table("news"), "source", "title", "link", "published") == [("F", "t", "l", "p")]
    assert table("news").where(F.col("processed_at").isNull()).count() == 0
    assert (folder / "base" / vocabulary.TABLE_FOLDERS["surveillance"] / "epi_week_key=__HIVE_DEFAULT_PARTITION__").exists()

    # A second run takes up only what is new.
    put(folder / "topics", "news", [{"source": "F", "title": "later"}], "b.txt")
    run_all(spark, configs, available_now=True)
    assert rows(table("news"), "title") == [("later",), ("t",)]
    assert table("surveillance").count() == 2


def test_tables_fit_their_declared_schema(spark, sources):
    folder, configs = sources
    run_all(spark, configs, available_now=True)
    for config in configs:
        stored = spark.read.parquet(config.path)
        assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in schemas.harmonised(config.name)}


def test_console_tee(spark, sources, capsys):
    from dataclasses import replace

    _, configs = sources
    queries = harmonize_stream(spark, replace(configs[1], tee=True), available_now=True)
    for q in queries:
        q.awaitTermination()
    assert [q.name for q in queries] == ["weather", "weather_console"]
    assert "Lahore" in capsys.readouterr().out


def test_harmonize_tables_too(spark):
    df = spark.createDataFrame([('{"epi_year": 2026, "epi_week": 27}',)], "value string")
    assert harmonize(df, schemas.WEATHER, "week").first().epi_week_key == "2026-W27"
    with pytest.raises(ValueError):
        harmonize(df, schemas.WEATHER, "daily")


def test_tables_are_streamed_as_files_and_as_folders(spark, tmp_path, rows):
    """A table of one file and one of several files in a folder give the same harmonised rows."""
    docs = spark.createDataFrame([(i, f"text {i}", "web") for i in range(6)], "doc_id long, text string, source string")
    docs.repartition(3).write.parquet(f"{tmp_path}/folder/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/one")
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "documents.parquet").write_bytes(next((tmp_path / "one").glob("part-*.parquet")).read_bytes())
    want = sorted([("web", f"text {i}", str(i), "") for i in range(6)], key=repr)
    for form in ("folder", "file"):
        assert rows(QUERIES["harmonize_plain"](spark, f"{tmp_path}/{form}"), "source", "title", "link", "published") == want


def test_kafka_reader_asks_for_the_connector(spark):
    """Without the connector on the class path the Kafka form fails by name, not by accident."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "t")
