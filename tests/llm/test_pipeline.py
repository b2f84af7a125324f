"""The pipeline stage by stage against brute force, on the smallest test tables."""

import re

import corpus_pipeline
from epilink.llm.queries import op9_decontamination
from epilink.llm.tables import table

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if "doc_id" in docs.columns else {}
        docs = stage(spark, docs, FOLDER)
        kept[name] = (before, {r.doc_id: (r.text if "text" in r else None) for r in docs.collect()})
        if name != "mixing":
            assert docs.columns == columns
    before, after = kept["exact_dedup"]
    plain = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in before.items()}
    assert set(after) == {min(i for i in plain if plain[i] == t) for t in set(plain.values())}
    before, after = kept["toxicity"]
    assert set(after) < set(before) and len(after) > 0.8 * len(before)
    before, after = kept["near_dedup"]
    assert set(after) <= set(before)
    before, after = kept["decontamination"]
    hits = {r.doc_id: r.n_hit for r in op9_decontamination(spark, FOLDER).collect()}
    assert all(after[i] == t for i, t in before.items() if not hits[i])
    assert all(after.get(i) != t for i, t in before.items() if hits[i])
    before, after = kept["mixing"]
    assert set(after) == set(before)
