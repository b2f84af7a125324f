"""Streams that write tables with a log: replays, merges, failures, one read for two sinks."""

import importlib
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from epilink import schemas, vocabulary
from epilink.operators.metrics import batch_metrics, summarize_metrics
from epilink.sinks import batches as sink
from epilink.sinks import clean_up, compact, spread, write_batch
from epilink.sources import entries, is_batch_table, live, read_batches, read_log, read_optional
from epilink.streaming import default_sources, harmonize_stream, run_all


@pytest.fixture
def table(tmp_path):
    return f"{tmp_path}/table"


def some(spark, n, start=0):
    return spark.range(start, start + n).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("key"))


def files(table, name="*"):
    from pathlib import Path

    return [p for p in Path(table).glob(f"data/batch={name}/**/*.parquet")]


def test_a_batch_counts_once(spark, table, rows):
    assert write_batch(some(spark, 10), 0, table, "key").rows == 10
    assert write_batch(some(spark, 10), 0, table, "key") is None
    assert write_batch(some(spark, 5, 10), 1, table, "key").rows == 5
    assert [(e.first, e.last, e.rows) for e in entries(spark, table)] == [(0, 0, 10), (1, 1, 5)]
    assert rows(read_batches(spark, table)) == rows(some(spark, 15))


def test_a_write_that_fails_leaves_nothing_to_read(spark, table, rows, monkeypatch):
    write_batch(some(spark, 10), 0, table, "key")

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(sink, "commit", lost)
    with pytest.raises(OSError):
        write_batch(some(spark, 5, 10), 1, table, "key")
    monkeypatch.undo()
    assert read_batches(spark, table).count() == 10
    assert write_batch(some(spark, 5, 10), 1, table, "key").rows == 5
    assert rows(read_batches(spark, table)) == rows(some(spark, 15))
    assert len(clean_up(spark, table, older_than_seconds=-5)) == 1
    assert rows(read_batches(spark, table)) == rows(some(spark, 15))


def test_files_per_key_are_bounded(spark, table):
    df = some(spark, 3000).repartition(12)
    # Adaptive execution would put parts as small as these together.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        entry = write_batch(df, 0, table, "key", rows_per_file=100, files_per_key=6)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by_key = {}
    for f in files(table, entry.batch):
        by_key.setdefault(f.parent.name, []).append(f)
    assert len(by_key) == 5 and all(len(v) <= 6 for v in by_key.values())
    assert len(by_key["key=hot"]) >= 2
    assert all(len(v) <= 3 for k, v in by_key.items() if k != "key=hot")
    assert spread(df, "key").count() == 3000


def test_null_keys_and_odd_columns(spark, table, rows):
    df = spark.createDataFrame([(1, None, {"a": 1}, "x"), (2, "b", None, None)], "id int, key string, m map<string,int>, _n string")
    write_batch(df, 0, table, "key")
    assert rows(read_batches(spark, table), "id", "key", "_n") == rows(df, "id", "key", "_n")


def test_merges_keep_rows_and_are_few(spark, table, rows):
    for i in range(9):
        write_batch(some(spark, 4, 4 * i), i, table, "key")
        compact(spark, table, "key", fan_in=2)
    now = live(entries(spark, table))
    assert [(e.level, e.first, e.last, e.rows) for e in now] == [(3, 0, 7, 32), (0, 8, 8, 4)]
    assert rows(read_batches(spark, table)) == rows(some(spark, 36))
    assert write_batch(some(spark, 4), 5, table, "key") is None
    assert clean_up(spark, table) == []
    before = len(files(table))
    assert clean_up(spark, table, older_than_seconds=-5)
    assert len(files(table)) < before and [e.batch for e in entries(spark, table)] == [e.batch for e in now]
    assert rows(read_batches(spark, table)) == rows(some(spark, 36))
    assert write_batch(some(spark, 4), 5, table, "key") is None


def test_log_rows_are_counted_once(spark, table):
    for i in range(4):
        write_batch(some(spark, 4, 4 * i), i, table, "key", failed=F.col("id") % 4 == 0)
    compact(spark, table, "key", fan_in=2)
    for old in (10**6, -5):
        clean_up(spark, table, older_than_seconds=old)
        total = summarize_metrics(batch_metrics(read_log(spark, table), "weather")).first()
        assert (total.records_attempted, total.records_succeeded) == (16, 12)


def test_empty_tables(spark, table):
    schema = schemas.fields(id=schemas.L)
    assert not is_batch_table(spark, table) and entries(spark, table) == []
    assert read_batches(spark, table, schema).count() == 0
    with pytest.raises(ValueError):
        read_batches(spark, table)
    write_batch(spark.createDataFrame([], schema), 0, table)
    assert read_batches(spark, table).count() == 0 and read_batches(spark, table).columns == ["id"]


@pytest.fixture
def weather(tmp_path):
    topic = tmp_path / "topics" / vocabulary.TOPICS["weather"]
    topic.mkdir(parents=True)
    for i in range(5):
        lines = [json.dumps({"district": f"d{i}-{k}", "epi_year": 2026, "epi_week": 20 + k, "temperature_c": 1.5}) for k in range(4)] + ["{broken"]
        (topic / f"{i}.txt").write_text("\n".join(lines) + "\n")
    (config,) = [c for c in default_sources(f"{tmp_path}/base", f"{tmp_path}/ckpt", folder=f"{tmp_path}/topics") if c.name == "weather"]
    return tmp_path, replace(config, sink="batches", options={"maxFilesPerTrigger": "1"})


def test_two_sinks_of_one_read(spark, weather, capsys):
    _, config = weather
    (query,) = harmonize_stream(spark, replace(config, tee=True), available_now=True)
    query.awaitTermination()
    # The source counts the rows of every read of a batch.
    progress = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert progress == [5] * 5
    assert "d3-2" in capsys.readouterr().out
    assert read_batches(spark, config.path).count() == 25


def test_jobs_read_what_is_committed(spark, weather, rows):
    folder, config = weather
    run_all(spark, [config], available_now=True)
    found = read_optional(spark, f"{folder}/base", vocabulary.TABLE_FOLDERS["weather"], schemas.harmonised("weather"))
    assert found.columns == schemas.harmonised("weather").names
    assert found.count() == 25 and found.where("epi_week_key = '2026-W21'").count() == 5
    log = batch_metrics(read_log(spark, config.path), "weather")
    assert sorted((r.records_attempted, r.records_failed) for r in log.collect()) == [(5, 1)] * 5
    assert {f.name for f in log.schema} == {f.name for f in schemas.METRICS}
    # Nothing new: nothing is written.
    run_all(spark, [config], available_now=True)
    assert found.count() == 25


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failed_batch_is_run_again(spark, weather, monkeypatch, when):
    """The sink fails once in the third batch, before or after the batch has been committed."""
    module = importlib.import_module("epilink.streaming.harmonize")

    _, config = weather
    calls = []

    def once(batch, batch_id, *args, **options):
        calls.append(batch_id)
        fail = batch_id == 2 and calls.count(2) == 1
        if fail and when == "before":
            raise OSError("lost")
        out = write_batch(batch, batch_id, *args, **options)
        if fail:
            raise OSError("lost")
        return out

    monkeypatch.setattr(module, "write_batch", once)
    with pytest.raises(Exception, match="lost"):
        run_all(spark, [config], available_now=True)
    run_all(spark, [config], available_now=True)
    assert calls.count(2) == 2
    found = read_batches(spark, config.path)
    assert found.count() == 25 and found.select("district").distinct().count() == 21
    calls.clear()


def test_restarts_by_itself(spark, weather, monkeypatch):
    module = importlib.import_module("epilink.streaming.harmonize")

    _, config = weather
    calls = []

    def twice(batch, batch_id, *args, **options):
        calls.append(batch_id)
        if batch_id in (1, 3) and calls.count(batch_id) == 1:
            raise OSError("lost")
        return write_batch(batch, batch_id, *args, **options)

    monkeypatch.setattr(module, "write_batch", twice)
    run_all(spark, [config], available_now=True, restarts=2)
    assert read_batches(spark, config.path).count() == 25
    assert calls == [0, 1, 1, 2, 3, 3, 4]
