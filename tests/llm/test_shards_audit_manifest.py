"""Sharding, filter audit and manifest against brute force, on small tables with odd rows."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from epilink.llm import filter_audit, hilbert, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("_row", "_task", "_place", "size", "shard", "slot", "doc", "curve", "tree", "place", "node", "found", "block", "part", "set", "filter", "fails", "_hash", "_words", "_text")


def clashing(docs):
    """With further columns that are named like those the operators use within."""
    return docs.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = ["plain", "words", "of", "Some", "TEXT", "é", "$5", "#tag", "&", " ", *(f"w{i}" for i in range(80))]
    out = []
    for i in range(230):
        k = rng.choice([0, 3, 49, 50, 51, 120])
        text = rng.choice([" ", "  ", "\n", "\x0b "]).join(rng.choices(vocabulary, k=k)) if i % 7 else "the same text again"
        out.append((i * 3, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "c", None, ""]), len(text)))
    out += [out[5], out[5], (15, "other text of id 15", "en", "a", 1), (None, "no id", "en", "a", 5), (None, "no id", "en", "b", 5)]
    out += [(9001, None, None, None, None), (9002, "", "en", "é", 0), (9003, "long " * 40000, "de", "lone", 200000), (-4, "the same text again", "en", "a", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def curve(spark, axes, bits):
    names = [f"a{i}" for i in range(axes)]
    cells = spark.range((1 << bits) ** axes)
    cells = cells.select(*[F.shiftright("id", i * bits).bitwiseAND((1 << bits) - 1).cast("int").alias(n) for i, n in enumerate(names)])
    kept = cells.withColumns({f"c{i}": F.col(n) for i, n in enumerate(names)})
    return [tuple(r)[:-1] for r in sorted(hilbert.curve_index(kept, names, bits).collect(), key=lambda r: r.curve)]


@pytest.mark.parametrize("axes,bits", [(2, 1), (2, 4), (3, 3), (4, 2), (1, 4)])
def test_curve_visits_every_cell_by_unit_steps(spark, axes, bits):
    path = curve(spark, axes, bits)
    assert len(set(path)) == len(path) == (1 << bits) ** axes
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_are_cut_by_law(spark, docs, rows, none, law):
    got = hilbert.place(clashing(docs), law=law).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i is None, i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    of = {s: sorted((r for r in got if r.shard == s), key=lambda r: r.slot) for s in range(16)}
    assert sum(map(len, of.values())) == len(rows)
    assert all([r.slot for r in own] == list(range(len(own))) for own in of.values())
    assert [r.curve for s in range(16) for r in of[s]] == sorted(r.curve for r in got)
    if law == "rows":
        assert max(map(len, of.values())) - min(map(len, of.values())) <= 1
    else:
        total, largest = sum(r.size for r in got), max(r.size for r in got)
        assert all(abs(sum(r.size for r in own) - total / 16) <= largest for own in of.values())
    assert hilbert.place(none, law=law).count() == 0
    few = hilbert.digest(hilbert.place(docs.limit(3), law=law))
    assert few.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and few.count() == 3


def test_repeats_and_one_hot_source_fill_many_shards(spark):
    docs = spark.createDataFrame([(7, "same", "en", "hot", 4)] * 90 + [(i, f"t{i}", "en", f"s{i % 9}", 2) for i in range(70)], DOCS)
    got = hilbert.place(docs).collect()
    assert sorted([r.shard for r in got].count(s) for s in range(16)) == [10] * 16
    with pytest.raises(ValueError):
        hilbert.place(docs, law="none")


def test_written_shards_prune_on_several_columns(spark, tmp_path):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "x" * rng.randint(0, 500), rng.choice("abcdefgh"), f"source-{rng.randint(0, 7)}", 1) for i in range(1600)], DOCS)
    path = hilbert.write_shards(docs, f"{tmp_path}/shards")
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    spans = hilbert.ranges(hilbert.place(docs, whole=True)).collect()
    assert sum(r.rows for r in spans) == 1600
    for column, value in (("source", "source-3"), ("lang", "c"), ("doc_id", 800)):
        hit = sum(r[f"min_{column}"] <= value <= r[f"max_{column}"] for r in spans)
        assert hit <= 11, (column, hit)


def audited(rows, labels):
    """The audit by going through every order."""
    texts = [(i, s or "", t or "") for i, t, _, s, _ in rows]
    least = {}
    for i, _, t in texts:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    fails = []
    for i, _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        fails.append(out | {"E": i is not None and least[t] < i})
    want = set()
    for part in {p for _, p, _ in texts}:
        own = [k for k, (_, p, _) in enumerate(texts) if p == part]
        lost = {f: [0] * 5 for f in "ABCDE"}
        steps = []
        for order in permutations("ABCDE"):
            left = set(own)
            for step, f in enumerate(order, 1):
                failing = {k for k in own if fails[k][f]}
                gone = failing & left
                lost[f][0] += len(gone)
                only = sum(1 for k in failing if sum(fails[k].values()) == 1)
                label = lambda kind: sum(1 for k in gone if labels.get(texts[k][0], (0, 0))[kind] == 1)
                left -= gone
                steps.append((part, "".join(order), step, f, len(left), len(gone), len(failing - gone), only, label(0), label(1)))
        want |= {(*s, lost[s[3]][0]) for s in steps}
    return want


def test_filter_audit_is_brute_force(spark, docs, rows, none):
    marks = {i: (i % 2, int(i % 5 == 0)) for i in range(0, 700, 3)}
    listed = [(i, q, t) for i, (q, t) in marks.items()] + [(15, 0, None), (15, 1, 1), (None, 1, 1), (99999, 1, 1)]
    marks[15] = (1, 1)
    labels = spark.createDataFrame(listed, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(clashing(docs), labels)
    assert got.columns == ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == audited(rows, marks)
    assert filter_audit.audit(none, labels).count() == 0
    alike = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)), "en", "z", 1)], DOCS)
    out = filter_audit.audit(alike, labels.limit(0)).collect()
    assert len(out) == 600 and {(r.kept, r.removed, r.shapley) for r in out} == {(1, 0, 0)}


def test_filter_audit_broadcasts_a_fixed_number_of_groups_only(spark, docs, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(0, 700, 3)], "doc_id long, quality int, toxic int")
    plans = {}

    def broadcasts(df):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return final.count("BroadcastHashJoin")

    def stored(df, label):
        plans[label] = broadcasts(df)
        return write(df, label)

    write = filter_audit.stored
    monkeypatch.setattr(filter_audit, "stored", stored)
    plans["out"] = broadcasts(filter_audit.audit(docs, labels))
    assert plans.pop("fails-E") <= 3  # Those of the largest groups.
    assert {"rows", "texts", "left-1", "left-5", "steps", "kept", "out"} <= set(plans) and not any(plans.values()), plans


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """Root, and the siblings (before, after) of every node level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    ways = []
    for i in range(len(nodes)):
        way = []
        for own in levels[:-1]:
            run = i // 3 * 3
            way.append((own[run:i], own[i + 1 : run + 3]))
            i //= 3
        ways.append(way)
    return levels[-1][0], ways


def manifested(rows):
    leaf = lambda r: H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    of = {}
    for i, t, lang, s, n in rows:
        cut = t.replace("\n", "") if t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t
        of.setdefault(s, []).append(((i is not None, i or 0), leaf((i, s, lang, n, t)), leaf((i, s, lang, n, cut)), i))
    names = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(of[s])]) for s in names}
    root, up = tree([trees[s][0] for s in names])
    want = []
    for s, beyond in zip(names, up):
        for (_, own, now, i), way in zip(sorted(of[s]), trees[s][1]):
            cur, proof = now, []
            for a, b in [*way, *beyond]:
                proof += [*a, *b]
                cur = H(*a, cur, *b)
            want.append((i, own, trees[s][0], root, H(*proof), cur, cur == root))
    return sorted(want, key=repr)


def found_leaf(docs):
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    cut = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.COLUMNS]
    return F.when(hit, merkle.leaf(cut))


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_is_brute_force(spark, docs, rows, none, levels):
    """Also with small superblocks, so that there are several tiers of them."""
    got = merkle.manifest(clashing(docs), found_leaf(docs), levels=levels)
    assert sorted(map(tuple, got.collect()), key=repr) == manifested(rows)


def test_manifest_of_few_rows(spark, none):
    assert merkle.manifest(none).count() == 0
    for n in (1, 3, 4):
        one = [(i, f"t{i}\n", "en", "a", 1) for i in range(n)]
        docs = spark.createDataFrame(one, DOCS)
        assert sorted(map(tuple, merkle.manifest(docs, found_leaf(docs), levels=1).collect()), key=repr) == manifested(one)


def test_many_sources(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 40}" if i % 41 else None, 1) for i in range(200)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS)).drop("folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((w[:5] for w in manifested(rows)), key=repr)
    assert merkle.manifest(spark.createDataFrame(rows, DOCS)).filter("not verified").count() == 0


def test_packed_proofs():
    steps = [([b"a" * 32], [b"b" * 32]), ([], []), ([], [b"c" * 32, b"d" * 32])]
    assert merkle.unpack(merkle.pack(steps)) == steps and merkle.unpack(b"") == []
