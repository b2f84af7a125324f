import re
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from epilink import schemas, vocabulary
from epilink.operators.graph import edge_table, graph_nodes, property_graph, route_triples
from epilink.operators.patterns import bgp, policy_status
from epilink.operators.triples import Entity, knowledge_graph, policy_statements, triples_from, union_triples
from epilink.sinks import predicate_tags, turtle_blocks, write_graph, write_ntriples, write_rdfxml, write_triples, write_turtle
from epilink.sources import parse_ntriples, read_ntriples, read_rejected_ntriples, read_triples, rejected_ntriples

NS = vocabulary.NAMESPACE
RDF, XSD = vocabulary.RDF_NAMESPACE, vocabulary.XSD_NAMESPACE


@pytest.fixture(scope="module")
def graph(spark):
    cases = spark.createDataFrame(
        [("Dera Ghazi Khan", "ili", 30), ("Dera Ghazi Khan", "dengue", 5), ("Dera Ghazi Khan", "malaria", 30), ("Karachi", "ili", 8), (None, "ili", 3)],
        "district_canonical string, disease string, case_count int",
    )
    weather = spark.createDataFrame(
        [("Dera Ghazi Khan", 34.6, 40.0), ("Dera Ghazi Khan", 40.2, 40.0), ("Karachi", 29.0, None)],
        "district_canonical string, temperature_c double, humidity_pct double",
    )
    alerts = spark.createDataFrame(
        [("Dera Ghazi Khan", "flood", "moderate"), ("Dera Ghazi Khan", "flood", "moderate")],
        "district_canonical string, event_type string, severity string",
    )
    policy = spark.createDataFrame(
        [("Indus Waters & Climate Adaptation Strategy", "Completed"), ('Plan "B" \\ draft', "Draft\nor\tActive"), ("Und/Oder", None)],
        "title string, status string",
    )
    return knowledge_graph(cases, weather, alerts, policy).cache()


def ex(name):
    return NS + name


def test_graph_is_a_set(graph, rows):
    got = rows(graph, "s", "p", "o", "o_kind", "o_datatype")
    assert len(got) == len(set(got)) == graph.count()
    place = ex("district/Dera_Ghazi_Khan")
    assert [t for t in got if t[0] == place and t[1] == ex("caseCount")] == [
        (place, ex("caseCount"), "30", "literal", XSD + "integer"),
        (place, ex("caseCount"), "5", "literal", XSD + "integer"),
    ]
    assert (place, ex("temperature"), "34.6", "literal", XSD + "double") in got
    assert (place, ex("humidity"), "40.0", "literal", XSD + "double") in got
    assert (ex("disaster/flood"), RDF + "type", ex("Disaster"), "iri", None) in got
    assert (ex("policy/Indus_Waters_&_Climate_Adaptation_Strategy"), ex("status"), "Completed", "literal", None) in got
    assert not [t for t in got if t[0] is None or t[2] is None]
    assert union_triples(graph, graph).count() == len(got)


def test_ntriples_round_trip(spark, graph, tmp_path, rows):
    path = write_ntriples(graph, f"{tmp_path}/g.nt")
    assert rows(read_ntriples(spark, path)) == rows(graph)


def test_ntriples_of_other_writers(spark, rows):
    lines = [
        "# comment",
        "",
        '<http://x/a>  <http://x/p> "caf\\u00E9 \\"q\\" \\\\n"@fr .',
        '<http://x/a> <http://x/p> "say \\"^^<http://x/t> .\\" now"^^<http://x/t>.',
        "<http://x/a> <http://x/p> <http://x/b> . ",
        '<http://x/a> <http://x/p> "" .',
        "broken",
    ]
    got = parse_ntriples(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(got, "o", "o_kind", "o_datatype") == sorted(
        [
            ('café "q" \\n', "literal", None),
            ('say "^^<http://x/t> ." now', "literal", "http://x/t"),
            ("http://x/b", "iri", None),
            ("", "literal", None),
        ],
        key=repr,
    )


def test_ntriples_keep_any_text(spark, tmp_path, rows):
    odd = ["", "\\", "\\\\\"", '"', "\n\r\t\f\v\b\0\x1f\x01", "a\u0085b\u2028c\u2029", "\U0001f600\ufdd0\ufdd1", "\\u0041 \\U00000041 \\'", "'", '" . # no comment', "a" * 5000 + "\n\\" * 5000]
    data = [(f"http://x/{x}", f"http://x/{x[:9]}", x, kind, type_) for x in odd for kind, type_ in (("literal", None), ("literal", "http://t/>"), ("iri", None)) if x]
    data += [("_:a", "http://x/p", "_:b", "iri", None), ("_:a", "http://x/p", "_:b", "literal", None)]
    made = spark.createDataFrame(data, schemas.TRIPLES)
    path = write_ntriples(made, f"{tmp_path}/odd.nt")
    assert rows(read_ntriples(spark, path)) == rows(made)
    assert read_rejected_ntriples(spark, path).count() == 0


def test_ntriples_that_are_rejected(spark, rows):
    good = ["", "  # note", '<a> <b> "x" . # "y"', '_:a.b <b> _:c .', "<a><b><c>.", '<a> <b> "\\uD83D\\uDE00\\U00000022"@en .']
    bad = ["<a> <b> .", '<a> <b> "x"', '<a> <b> "x"y" .', '<a> <b> "\\q" .', '<a> <b> "\\uD83D" .', '<a> <b> "\\U00110000" .', '<a> <b\\q> "" .', '"a" <b> <c> .', '<a> <b> "\ufdd0" .', '<a> <b> "\\" .']
    lines = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "value string")
    assert rows(rejected_ntriples(lines)) == sorted(((x,) for x in bad), key=repr)
    assert {r.o for r in parse_ntriples(lines).collect()} == {"x", "_:c", "c", '\U0001f600"'}


def test_stored_graph_is_read_by_predicate(spark, graph, tmp_path, rows):
    stored = read_triples(spark, write_triples(graph, f"{tmp_path}/stored"))
    assert rows(stored) == rows(graph)
    found = policy_status(stored)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p#" in text and "ExistingRDD" not in text
    assert rows(found) == rows(policy_status(graph))


def test_turtle_layout(graph):
    statements = [r.value for r in turtle_blocks(graph).where(F.col("s") == ex("district/Dera_Ghazi_Khan")).orderBy("place", "verb", "number", "term").collect()]
    place = f"<{NS}district/Dera_Ghazi_Khan>"
    assert statements == [
        f"{place} {x} ."
        for x in [
            "a ex:District",
            "ex:caseCount 5",
            "ex:caseCount 30",
            f"ex:hasDisaster <{NS}disaster/flood>",
            *[f"ex:hasDisease <{NS}disease/{d}>" for d in ("dengue", "ili", "malaria")],
            "ex:humidity 4e+01",
            'ex:severity "moderate"',
            "ex:temperature 3.46e+01",
            "ex:temperature 4.02e+01",
        ]
    ]
    titled = turtle_blocks(graph).where((F.col("s") == ex('policy/Plan_"B"_\\_draft')) & (F.col("verb") == "ex:title")).first()
    assert titled.value == f'<{NS}policy/Plan_\\u0022B\\u0022_\\u005C_draft> ex:title "Plan \\"B\\" \\\\ draft" .'


def test_turtle_files(graph, tmp_path):
    folder = Path(write_turtle(graph, f"{tmp_path}/g.ttl"))
    texts = [f.read_text() for f in sorted(folder.glob("part-*")) if f.stat().st_size]
    assert all(t.startswith("@prefix ex: <") and t.count("@prefix ex:") == 1 for t in texts)
    lines = [line for t in texts for line in t.split("\n") if line.startswith("<")]
    assert len(lines) == graph.count()
    subjects = [line.split(" ")[0] for line in lines]
    assert sum(a != b for a, b in zip(subjects, subjects[1:])) + 1 == len(set(subjects))


def test_rdfxml_files_hold_every_triple(spark, graph, tmp_path, rows):
    more = [("http://x/a", "http://y/z#knows", "http://x/b", "iri", None), ("_:n1", "http://y/z#knows", "_:n2", "iri", None), ("http://x/a", "http://w/name", "n", "literal", None)]
    whole = graph.unionByName(spark.createDataFrame(more, schemas.TRIPLES))
    folder = Path(write_rdfxml(whole, f"{tmp_path}/g.rdf"))
    found = set()
    node_name = lambda a, key: a.get(f"{{{RDF}}}{key}") or (f"_:{a[f'{{{RDF}}}nodeID']}" if f"{{{RDF}}}nodeID" in a else None)
    for file in folder.glob("part-*"):
        root = ET.parse(file).getroot()
        assert root.tag == f"{{{RDF}}}RDF"
        for node in root:
            s = node_name(node.attrib, "about")
            for child in node:
                p = child.tag[1:].replace("}", "")
                resource = node_name(child.attrib, "resource")
                found.add((s, p, resource or child.text, "iri" if resource else "literal", child.attrib.get(f"{{{RDF}}}datatype")))
    flat = lambda t: (t[0], t[1], re.sub(r"\s", " ", t[2]), t[3], t[4])
    assert {flat(t) for t in found} == {flat(t) for t in rows(whole)}
    with pytest.raises(ValueError):
        predicate_tags(["http://x/1"], NS)


def test_policy_status(graph, rows):
    assert rows(policy_status(graph)) == [
        ("Indus_Waters_&_Climate_Adaptation_Strategy", "Completed"),
        ('Plan_"B"_\\_draft', "Draft\nor\tActive"),
    ]


def test_patterns_match_brute_force(spark, rows):
    import itertools
    import random

    rnd = random.Random(5)
    terms = ["u", "v", "w"]
    data = {(rnd.choice(terms), rnd.choice("pq"), rnd.choice(terms), rnd.choice(["iri", "literal"]), None) for _ in range(25)}
    triples = spark.createDataFrame(sorted(data, key=repr), schemas.TRIPLES)
    patterns = [("?a", "p", "?b"), ("?b", "q", "?c"), ("?a", "q", "?c")]
    want = sorted(
        {
            (x[0], x[2], y[2], y[3], z[3])
            for x, y, z in itertools.product(data, repeat=3)
            if x[1] == "p" and y[1] == z[1] == "q" and x[3] == "iri" and x[2] == y[0] and z[0] == x[0] and y[2:4] == z[2:4]
        }
    )
    assert rows(bgp(triples, patterns, ["a", "b", "c"])) == sorted((w[:3] for w in want), key=repr)
    loops = bgp(triples, [("?a", "p", "?a")])
    assert rows(loops) == sorted({(t[0],) for t in data if t[1] == "p" and t[0] == t[2] and t[3] == "iri"})
    constants = bgp(triples, [("?a", "p", '"u"')])
    assert rows(constants) == sorted((t[0],) for t in data if t[1] == "p" and t[2] == "u" and t[3] == "literal")
    with pytest.raises(ValueError):
        bgp(triples, [("?a", "p", "?b"), ("?c", "q", "?d")])


def test_property_graph(spark, graph, tmp_path, rows):
    nodes, edges = property_graph(graph)
    assert ("Policy", "Und") not in rows(nodes) and ("Policy", "Oder") in rows(nodes)
    assert ("District", "Karachi") in rows(nodes) and ("Disease", "ili") in rows(nodes)
    assert rows(edges) == [
        ("District", "Dera_Ghazi_Khan", "HAS_DISASTER", "Disaster", "flood"),
        ("District", "Dera_Ghazi_Khan", "HAS_DISEASE", "Disease", "dengue"),
        ("District", "Dera_Ghazi_Khan", "HAS_DISEASE", "Disease", "ili"),
        ("District", "Dera_Ghazi_Khan", "HAS_DISEASE", "Disease", "malaria"),
        ("District", "Karachi", "HAS_DISEASE", "Disease", "ili"),
    ]
    write_graph(nodes, edges, f"{tmp_path}/g")
    write_graph(nodes.limit(1), edges.limit(0), f"{tmp_path}/g")
    assert spark.read.parquet(f"{tmp_path}/g/nodes").count() == 1
    assert spark.read.parquet(f"{tmp_path}/g/edges").count() == 0


def test_routes_take_the_first_match(spark):
    data = [("s", "x/hasDiseaseAndhasDisaster", "o", "iri", None), ("s", "x/subtitle", "o", "iri", None), ("s", "title/x", "o", "iri", None)]
    routed = route_triples(spark.createDataFrame(data, schemas.TRIPLES))
    assert {r.p: r.route for r in routed.collect()} == {"hasDiseaseAndhasDisaster": "HAS_DISEASE", "subtitle": "POLICY", "x": None}


def test_edges_and_nodes(spark, rows):
    data = [("n/a", "n/p", "n/b", "iri", None), ("n/a", "n/q", "n/b", "iri", None), ("n/b", "n/p", "1/2", "literal", None)]
    edges = edge_table(spark.createDataFrame(data, schemas.TRIPLES))
    assert rows(edges) == [("a", "b", "q"), ("b", "2", "p")]
    assert rows(graph_nodes(edges)) == [("2",), ("a",), ("b",)]


def test_other_namespace(spark):
    df = spark.createDataFrame([("T 1", "Draft")], "title string, status string")
    made = triples_from(df, policy_statements("http://kg.test/")).where(F.col("p") == "http://kg.test/status").first()
    assert made.s == "http://kg.test/policy/T_1"


def test_forms_that_may_spell_the_same_triple_stay_a_set(spark):
    from epilink.operators.triples import Form, Statement, triples_of

    wide = Statement(Form("http://x/", "p", kind="literal"), F.col("whole"), F.col("v"))
    narrow = Statement(Form("http://x/a/", "p", kind="literal"), F.col("part"), F.col("v"))
    df = spark.createDataFrame([("a/1", "1", "t"), ("a/2", "3", "t")], "whole string, part string, v string")
    got = [r.s for r in triples_of((df, [wide, narrow])).collect()]
    assert sorted(got) == ["http://x/a/1", "http://x/a/2", "http://x/a/3"]


def test_pattern_constants_tell_types_apart(spark):
    from epilink.operators.patterns import bgp

    whole = "http://www.w3.org/2001/XMLSchema#integer"
    rows = [("a", "p", "5", "literal", None), ("b", "p", "5", "literal", whole), ("c", "p", '"5"', "literal", None), ("d", "p", "5", "iri", None)]
    made = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_datatype string")
    for constant, want in (('"5"', "a"), (f'"5"^^<{whole}>', "b"), ('""5""', "c"), ("5", "d")):
        assert [r.s for r in bgp(made, [("?s", "p", constant)]).collect()] == [want]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_cut_once_a_row(spark):
    """The filter on statements must not repeat the work of cutting lines and undoing escapes."""
    text = optimized(parse_ntriples(spark.range(1).select(F.col("id").cast("string").alias("value"))))
    assert text.count("regexp_replace(replace(") == 1


def test_turtle_looks_at_the_digits_of_a_double_once(spark):
    made = spark.createDataFrame([("a", "b", "1.5", "literal", vocabulary.XSD_DOUBLE)], schemas.TRIPLES)
    text = optimized(turtle_blocks(made))
    assert text.count("[eE]") == 1 and text.lower().count("log10(abs") <= 4


def test_numbers_are_merged_as_numbers(spark):
    """Numbers become text after the merge; the two zeros stay two texts, and all NaN are one."""
    rows = spark.createDataFrame([(x,) for x in (0.0, -0.0, 2.5, 2.5, float("nan"), float("nan"), None)], "x double")
    made = triples_from(rows, [Entity("http://x/", "k", F.lit("a b")).has_double("p", F.col("x")), Entity("http://x/", "k", F.lit("n")).has_integer("q", F.col("x"))])
    assert "number#" in re.search(r"Aggregate \[([^\]]*)\]", optimized(made))[1]
    got = sorted((r.s, r.p, r.o) for r in made.collect())
    assert got == [("http://x/k/a_b", "p", o) for o in ("-0.0", "0.0", "2.5", "nan")] + [("http://x/k/n", "q", o) for o in ("0", "2")]
