"""Stored graphs: merges, statistics, join order, and the jobs that read them."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from epilink import schemas, vocabulary
from epilink.operators.patterns import PredicateStatistics, bgp, join_order, statistics_of
from epilink.operators.triples import surveillance_statements, triples_from
from epilink.plans import jobs
from epilink.sinks import clean_up, compact, merge_graph, write_ntriples
from epilink.sources import entries, live, read_graph, read_statistics


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(spark, rows):
    return spark.createDataFrame(rows, schemas.TRIPLES)


def iri(s, p, o):
    return (s, p, o, "iri", None)


@pytest.fixture
def store(tmp_path):
    return f"{tmp_path}/store"


def test_merge_adds_what_is_absent(spark, store, rows):
    first = [iri("a", "p", "b"), ("a", "q", "b", "literal", None), ("a", "q", "1", "literal", "int")]
    second = [iri("a", "p", "b"), ("a", "q", "b", "literal", "string"), ("a", "q", "1", "literal", "int"), iri("a", "q", "b"), iri("z", "r", "b")]
    assert merge_graph(made(spark, first + first), store) == 3
    assert merge_graph(made(spark, second), store) == 3
    assert merge_graph(made(spark, first + second), store) == 0
    assert merge_graph(made(spark, []), store) == 0
    assert rows(read_graph(spark, store)) == sorted(set(first + second), key=repr)


def test_merge_reads_the_touched_predicates(spark, store, monkeypatch):
    from epilink.sinks import graph_store as module

    merge_graph(made(spark, [iri(f"s{i}", f"p{i % 5}", "o") for i in range(50)]), store)
    seen = []

    def looked(triples, stored):
        out = original(triples, stored)
        return out

    original = module.new_triples
    kept = module.settle
    monkeypatch.setattr(module, "settle", lambda df: (seen.append(plan(df)), kept(df))[1])
    merge_graph(made(spark, [iri("s7", "p2", "o"), iri("new", "p2", "o")]), store)
    scan = next(p for p in seen if "LeftAnti" in p)
    assert "PartitionFilters" in scan and "p#" in scan and "p IN (p2)" in scan.replace("p#", "p IN (p2)") or "(p2)" in scan
    assert read_graph(spark, store).count() == 51


def test_statistics_add_up_over_merges_and_compactions(spark, store):
    rng = random.Random(1)
    triples = [iri(f"s{rng.randint(0, 400)}", f"p{rng.randint(0, 2)}", f"o{rng.randint(0, 30)}") for _ in range(2000)]
    for i in range(10):
        merge_graph(made(spark, triples[200 * i : 200 * i + 200]), store)
    assert any(e.level == 1 for e in live(entries(spark, store)))
    found = read_statistics(spark, store)
    for p in ("p0", "p1", "p2"):
        own = {t for t in triples if t[1] == p}
        assert found[p].rows == len(own)
        assert abs(found[p].subjects / len({t[0] for t in own}) - 1) < 0.05
        assert abs(found[p].objects / len({t[2] for t in own}) - 1) < 0.05
    clean_up(spark, store, older_than_seconds=-5)
    assert read_statistics(spark, store) == found and read_graph(spark, store).count() == len(set(triples))


PATTERNS = [("?a", "big", "?b"), ("?b", "mid", "?c"), ("?c", "small", "?d")]
SIZES = {"big": PredicateStatistics(1e6, 1e5, 1e5), "mid": PredicateStatistics(1e4, 1e4, 100), "small": PredicateStatistics(10, 10, 5)}


def test_order_does_not_depend_on_the_written_one():
    orders = {tuple(join_order(list(p), SIZES)) for p in itertools.permutations(PATTERNS)}
    assert orders == {(PATTERNS[2], PATTERNS[1], PATTERNS[0])}
    assert join_order(PATTERNS) == PATTERNS
    # A constant makes the large pattern the smallest one.
    fixed = [("?a", "big", "here"), ("?a", "mid", "?c"), ("?c", "small", "?d")]
    sizes = SIZES | {"big": PredicateStatistics(1e6, 1e5, 1e6)}
    assert join_order(fixed[::-1], sizes)[0] == fixed[0]
    with pytest.raises(ValueError):
        join_order([("?a", "big", "?b"), ("?x", "mid", "?y")], SIZES)
    assert join_order([("?a", "none", "?b"), ("?b", "big", "?c")], SIZES)[0][1] == "none"


def test_worst_order_gives_the_plan_and_rows_of_the_best(spark, store, rows):
    rng = random.Random(2)
    triples = [iri(f"x{rng.randint(0, 300)}", "big", f"y{rng.randint(0, 50)}") for _ in range(1500)]
    triples += [iri(f"y{i}", "mid", f"z{i % 7}") for i in range(50)] + [iri("z1", "small", "end"), ("z2", "small", "text", "literal", None)]
    merge_graph(made(spark, triples), store)
    graph, sizes = read_graph(spark, store), read_statistics(spark, store)
    names = ["a", "b", "c", "d"]
    same = lambda df: __import__("re").sub(r"#\d+L?|plan_id=\d+|\[id=[^\]]*\]", "", plan(df))
    found = [bgp(graph, list(p), names, sizes) for p in itertools.permutations(PATTERNS)]
    assert len({same(df) for df in found}) == 1
    assert rows(found[0]) == rows(bgp(graph, PATTERNS, names))
    assert "kind" not in plan(found[0]).split("Project")[1]
    assert {x: y for x, y in statistics_of(graph).items() if x == "small"}["small"].rows == 2


def test_variables_that_only_stand_for_objects_keep_their_kind(spark, rows):
    triples = made(spark, [("a", "p", "x", "iri", None), ("b", "q", "x", "literal", None), ("c", "q", "x", "iri", None), ("d", "q", "x", "literal", "t"), ("e", "p", "x", "literal", "t")])
    assert rows(bgp(triples, [("?s", "p", "?o"), ("?t", "q", "?o")])) == [("a", "x", "c"), ("e", "x", "d")]
    assert rows(bgp(triples, [("?s", "q", "?o")])) == [("b", "x"), ("c", "x"), ("d", "x")]


def test_jobs_read_the_store_by_predicate(spark, tmp_path, rows):
    place = lambda x: f"{vocabulary.NAMESPACE}district/{x}"
    ns = vocabulary.NAMESPACE
    triples = [iri(place("A"), ns + "hasDisease", ns + "disease/flu"), iri(place("A"), ns + "hasDisaster", ns + "disaster/flood")]
    triples += [iri(ns + "policy/P", vocabulary.RDF_TYPE, ns + "Policy"), (ns + "policy/P", ns + "title", "P", "literal", None)]
    triples += [(ns + "policy/P", ns + "status", "Draft", "literal", None), (place("A"), ns + "temperature", "1.0", "literal", vocabulary.XSD_DOUBLE)]
    store, text = f"{tmp_path}/store", f"{tmp_path}/graph.nt"
    merge_graph(made(spark, triples), store)
    write_ntriples(made(spark, triples), text)
    assert rows(jobs.policy_job(spark, store)) == rows(jobs.policy_job(spark, text)) == [("P", "Draft")]
    for kind in ("store", "text"):
        jobs.property_graph_job(spark, store if kind == "store" else text, f"{tmp_path}/{kind}")
        jobs.edge_job(spark, store if kind == "store" else text, f"{tmp_path}/{kind}-edges")
    for name in ("nodes", "edges"):
        assert rows(spark.read.parquet(f"{tmp_path}/store/{name}")) == rows(spark.read.parquet(f"{tmp_path}/text/{name}"))
    assert rows(spark.read.parquet(f"{tmp_path}/store-edges")) == rows(spark.read.parquet(f"{tmp_path}/text-edges"))
    routed = jobs._routed(spark, store)
    assert "PartitionFilters: [isnotnull(p" in plan(routed) or "PartitionFilters: [p#" in plan(routed)
    assert routed.count() == 3


def test_counts_beyond_32_bits(spark):
    cases = spark.createDataFrame([("A", "flu", 3_000_000_000)], "district_canonical string, disease string, case_count long")
    held = triples_from(cases, surveillance_statements()).where(F.col("p").endswith("caseCount")).collect()
    assert [r.o for r in held] == ["3000000000"]


def test_empty_graph(spark, store):
    assert merge_graph(made(spark, []), store) == 0
    assert read_graph(spark, store).count() == 0 and read_statistics(spark, store) == {}
    assert compact(spark, store, "p") == []
