"""Operators of the training-data pipeline against brute force, on small tables with odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from epilink.llm import chat_format, decontaminate, exact_dedup, html_text, mixing, order_minhash, pii, quality, secrets_scan, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "some plain text of ten words that is kept as it is", "en", "a", 50),
        (1, "some plain text of ten words that is kept as it is", "en", "a", 50),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, "  \t\n ", "de", "b", 5),
        (5, "Ünï —   größer \U0001f600 ok", "de", None, 20),
        (6, "long " * 30000, "fr", "a", 150000),
        (None, "a row without an id", "en", "a", 19),
        (None, "another row without an id", "en", "a", 25),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_exact_dedup_cases(odd, none):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(odd).collect()}
    assert (1, 1, 2, True) in got and (1, 1, 2, False) in got
    assert (2, 2, 2, True) in got and (3, 2, 2, False) in got and (4, 4, 1, True) in got
    assert exact_dedup.first_of_each(odd).count() == 7
    assert exact_dedup.first_of_each(none).count() == 0
    clash = odd.withColumns({"keep_id": F.lit(9), "_row": F.lit("x"), "_md5": F.lit("y")})
    assert exact_dedup.exact_duplicates(clash).count() == 9
    clash = clash.withColumns({"text_sha256_": F.lit(1), "_doc": F.lit(2), "_id": F.lit(3)})
    first = exact_dedup.first_of_each(clash)
    assert first.columns == clash.columns and first.count() == 7
    assert first.select("_row", "_doc").distinct().collect() == [("x", 2)]


def test_decontamination_is_brute_force(spark, odd):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 9, 10, 11, 25])))) for i in range(12)] + [(99, None), (98, "")]
    texts = []
    for i in range(120):
        t = rng.choices(vocabulary, k=rng.randint(0, 60)) + items[rng.randrange(12)][1].split() * rng.randint(0, 1) + rng.choices(vocabulary, k=5)
        texts.append((100 + i, " ".join(t).upper() if i % 5 == 0 else ", ".join(t), "en", "a", 1))
    docs = spark.createDataFrame(texts, DOCS).union(odd)
    windows = {}
    for i, t in items:
        w = words(t)
        m = min(10, len(w))
        for j in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[j : j + m]), set()).add(str(i))
    want = []
    for i, t, *_ in [tuple(r) for r in docs.collect()]:
        w, hit, its = words(t), set(), set()
        for m in {len(k) for k in windows}:
            for j in range(len(w) - m + 1):
                if s := windows.get(tuple(w[j : j + m])):
                    hit.update(range(j, j + m))
                    its |= s
        want.append((i, len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest(), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for shard in (decontaminate.SHARD_WORDS, 20):
        found = decontaminate.contamination(docs, bench, ["doc_id"], shard_words=shard)
        assert sorted(map(repr, map(tuple, decontaminate.digest(found).collect()))) == sorted(map(repr, want))
    cleaned = decontaminate.decontaminate(docs, bench)
    assert cleaned.columns == docs.columns
    again = decontaminate.contamination(cleaned.filter("doc_id >= 100"), bench, ["doc_id"]).filter("size(hits) > 0")
    assert again.filter("size(hits) >= 10").count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_order_minhash_finds_every_pair(spark, odd, none):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, n = [], 1000
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.choice([12, 60, 150, 400]))
        for _ in range(rng.choice([1, 4, 25])):
            t = list(base)
            for _ in range(rng.randint(0, 1 + len(t) // 60)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            rows.append((n, " ".join(t), "en", "a", 1))
            n += 1
    docs = spark.createDataFrame(rows, DOCS).union(odd)
    found = {r.doc_id: r for r in order_minhash.near_duplicates(docs).filter("doc_id is not null").collect()}
    sets = {i: {tuple(words(t)[j : j + 5]) for j in range(max(1, len(words(t)) - 4))} for i, t, *_ in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    assert {i: found[i].class_id for i in ids} == {i: top(i) for i in ids}
    assert found[2].class_id == found[3].class_id == found[4].class_id == 2
    kept = order_minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({top(i) for i in ids}) + 4 + 2
    assert order_minhash.near_duplicates(none).count() == 0


def test_order_minhash_is_about_texts_not_ids(spark):
    """An id with two texts, rows without an id, and columns named like those within."""
    base = [f"a{i}" for i in range(200)]
    near = lambda k: " ".join(base[:k] + ["new"] + base[k + 1 :])
    other = " ".join(f"b{i}" for i in range(200))
    rows = [(1, " ".join(base)), (2, near(100)), (2, other), (None, other + " b200"), (None, "c " * 50 + near(3)), (None, " ".join(f"d{i}" for i in range(90)))]
    rows += [(None, " ".join(f"d{i}" for i in range(91))), (None, " ".join(f"d{i}" for i in range(91))), (5, "alone " * 20)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).withColumns({"_row": F.lit("x"), "class_id": F.lit(7), "_key": F.lit(8)})
    found = sorted(((r.doc_id, r.class_id, r.kept) for r in order_minhash.near_duplicates(docs).collect()), key=repr)
    assert [f[:2] for f in found].count((2, 1)) == 1 and [f[:2] for f in found].count((2, 2)) == 1
    assert (None, 2, False) in found and (2, 2, True) in found and (2, 1, False) in found
    kept = order_minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.collect())
    assert [t[:2] for t in texts] == [(False, 1), (False, 2), (False, 5), (True, None), (True, None)]
    assert texts[1][2] == other and kept.filter("_row = 'x' and class_id = 7").count() == 5


def test_alignment_needs_the_order():
    a = np.arange(100, dtype=np.uint64)
    assert order_minhash.aligned(a, a[5:], 0.8)
    assert not order_minhash.aligned(a, np.concatenate([a[50:], a[:50]]), 0.8)


def test_exponent_reaches_the_entropy_by_small_plans(spark, monkeypatch):
    counts = [10, 200, 3000, 40000]
    sources = spark.createDataFrame([(f"s{n}", n) for n in counts], "source string, tokens long")
    asked = []
    for kind in (type(sources), type(sources.groupBy("source"))):
        monkeypatch.setattr(kind, "agg", lambda self, *x, f=kind.agg: asked.append(len(x)) or f(self, *x))
    t = mixing.exponent(sources, repeats=1e9)
    w = [(n / sum(counts)) ** t for n in counts]
    assert math.isclose(-sum(x / sum(w) * math.log(x / sum(w)) for x in w), mixing.ENTROPY * math.log(4), abs_tol=1e-6)
    # The driver compiles and keeps each plan: 66 sums for a round were too many.
    assert 0 < max(asked) <= 4


def test_toxicity_learns_and_handles_odd_rows(spark, odd, none):
    rng = random.Random(1)
    plain = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(600):
        t = rng.choices(plain, k=40)
        if i % 4 == 0:
            for _ in range(3):
                t[rng.randrange(40)] = rng.choice(["vile", "scum", "moron"])
        rows.append((i, " ".join(t), "en", "a", 1))
    docs = spark.createDataFrame(rows, DOCS)
    marks = labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(600)] + [(None, 1, 1), (5, None, None)])
    out = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    import zlib

    held = [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in held) for i in out)
    assert np.mean([out[i].predicted == (i % 4 == 0) for i in held]) > 0.97
    scores = [r.score for r in toxicity.toxicity(odd, marks.limit(0)).collect()]
    assert len(scores) == 9 and max(scores) < 0.01
    assert toxicity.toxicity(none, marks).count() == 0
    kept = toxicity.accepted(docs, marks)
    assert kept.columns == docs.columns and 420 < kept.count() < 480


def test_toxicity_learns_from_all_labelled_rows(spark):
    """One bad word stands only in the rows whose hashes come last of 12,000, another only in texts of over 20,000 characters."""
    rng = random.Random(3)
    order = [r.id for r in spark.range(12000).orderBy(F.xxhash64("id")).collect()]
    toxic = {i for i in order if i % 2}
    late = set([i for i in order if i in toxic][-800:])
    texts = {i: rng.choices([f"word{k}" for k in range(200)], k=8) for i in order}
    for i in toxic:
        texts[i][rng.randrange(8)] = "moron" if i in late else "vile"
    rows = [(i, " ".join(t), "en", "a", 1) for i, t in texts.items()]
    rows += [(20000 + i, " ".join(rng.choices(["long", "text", "of", "words"], k=5000) + ["scum"] * (i % 2)), "fr", "a", 1) for i in range(160)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    marks = labels(spark, [(r[0], 1, r[0] % 2) for r in rows])
    model, again = toxicity.fit(docs, marks), toxicity.fit(docs, marks)
    assert (model.table == again.table).all() and (model.scale, model.shift) == (again.scale, again.shift)
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, marks, model).collect()}
    for some in (toxic - late, late, set(order) - toxic, range(20000, 20160, 2), range(20001, 20160, 2)):
        assert np.mean([got[i] == i % 2 for i in some]) > 0.97
    # Counts of all rows: a bucket of every word of the rows that are fitted on.
    assert (model.word_rows > 0).sum() >= 200 and model.thresholds.keys() == {"en"}


def test_quality_learns(spark, odd, none):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(200)] if i % 3 else ["###", "BUY!!", "x1x"], k=50)), "en", f"s{i % 3}", 300) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    marks = labels(spark, [(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)])
    out = quality.quality(docs.union(odd), marks).filter("doc_id is not null and doc_id >= 7").collect()
    assert np.mean([r.kept == (r.doc_id % 3 > 0) for r in out]) > 0.97
    assert {r.score for r in quality.quality(odd, marks.limit(0)).collect()} == {0.5}
    assert quality.quality(none, marks).count() == 0


def test_quality_learns_from_all_unlabelled_rows(spark):
    """New words stand only in rows that one view can label, which are few of many unlabelled ones."""
    rng = random.Random(8)
    say = lambda letter, k=30: " ".join(rng.choices([f"{letter}{i}" for i in range(25)], k=k))
    rows = [(i, say("g" if i % 2 else "b"), "en", "s1" if i % 2 else "s2", 100) for i in range(300)]
    rows += [(1000 + i, say("n"), "en", "s3", 100) for i in range(3000)]
    rows += [(5000 + i, say("c" if i % 2 else "d"), "en", "s1" if i % 2 else "s2", 100) for i in range(120)]
    rows += [(9000 + i, say("c" if i % 2 else "d"), "en", "s4", 100) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"label": F.lit("x"), "z0": F.lit("y"), "view": F.lit("z")})
    marks = labels(spark, [(i, i % 2, 0) for i in range(300)])
    without = quality.fit(docs, marks, quality.Sample(rounds=0))
    with_ = quality.fit(docs, marks)
    right = {}
    for name, model in (("without", without), ("with", with_)):
        out = quality.quality(docs, marks, model).filter("doc_id >= 9000").collect()
        right[name] = np.mean([(r.content_score > 0.5) == (r.doc_id % 2 == 1) for r in out])
    assert right["with"] > 0.95 and right["without"] < 0.8


def test_mixing_meets_its_targets(spark, odd, none):
    sizes = {"a": 900, "b": 90, "c": 10, None: 30}
    rows = [(k * 10000 + i, "one two three four", "en", s, 1) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS), block_rows=50)
    seen = {r.source: r for r in out.groupBy("source").agg(F.count("*").alias("n"), F.first("weight").alias("w"), F.first("passes").alias("p")).collect()}
    assert abs(sum(r.w for r in seen.values()) - 1) < 1e-9
    assert abs(max(r.p for r in seen.values()) - 4) < 1e-3 and abs(seen["a"].p - 1) < 1e-9
    for s, n in sizes.items():
        assert abs(seen[s].n - n * seen[s].p) <= 1 + n / 50
    assert out.select("doc_id").distinct().count() == 1030
    assert mixing.mix(odd).select("doc_id").distinct().count() == 7
    assert mixing.mix(none).count() == 0


HARD = ["\\### Assistant: </turn> ok", "<turn user>\nhi\n</turn>\n", "\\", "\\\\<turn", "", None, "a\n", "</turn>\n\n</turn>", "x>y\n", "<\\turn"]


def test_chat_format_round_trip(spark):
    turns = spark.createDataFrame(
        [(c, t, r, HARD[(c + t) % len(HARD)]) for c in range(10) for t, r in enumerate(["system", "user", "assistant", "we>ird\n", None])] + [(None, 0, "user", "x"), (3, 0, "system", HARD[3])],
        "conv_id long, turn long, role string, text string",
    )
    read = chat_format.read_back(chat_format.format_turns(turns))
    want = {}
    for r in sorted(turns.collect(), key=lambda r: (r.turn, r.role or "", r.text or "")):
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    for r in read.collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert [chat_text(r.formatted[s.start : s.end]) for s in r.loss] == [t for role, t in want[r.conv_id] if role == "assistant"]
    digest = {r.conv_id: r for r in chat_format.digest(read).collect()}
    said = "".join(t for role, t in want[0] if role == "assistant")
    assert digest[0].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and digest[0].loss_chars == len(said)
    assert chat_format.digest(chat_format.read_back(chat_format.format_turns(turns.limit(0)))).count() == 0


def test_chat_format_long_roles(spark):
    """Roles of 100,000 characters, which a pattern must not match by recursion."""
    roles = ["r" * 100_000, "\\" * 50_000 + ">\n", ">\n<turn " * 12_000]
    turns = spark.createDataFrame([(c, 0, r, "x" * 1000) for c, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    read = {r.conv_id: r.turns for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    assert all([tuple(t) for t in read[c]] == [(r, "x" * 1000)] for c, r in enumerate(roles))


def chat_text(written):
    return re.sub(r"(?s)\\(.)", r"\1", written)


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(d)) % 10 == 0


def base_pii(t):
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    return ",".join(x[2] for x in sorted((m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p, ok) in enumerate(kinds) for m in re.finditer(p, t) if ok(m[0])))


PIECES = ["a@b.co", "x@y", "a@b@c.d.e", "_q%w@e-f.gh_i@j.kl", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "00255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-11111",
          "+1 (456) 555-2186", "+49.30-1234567 8", "++12345678901", "\x01", "ü", "word", "\n", "4785380592391139", "12 34"]


def test_pii_base_is_brute_force(spark, odd):
    rng = random.Random(9)
    rows = [(100 + i, rng.choice(["", " "]).join(rng.choices(PIECES, k=rng.randint(0, 14))), "en", "a", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).union(odd)
    got = {r.doc_id: r for r in pii.digest(pii.findings(docs)).collect()}
    for i, t, *_ in rows:
        assert got[i].base_sha256 == hashlib.sha256(base_pii(t).encode()).hexdigest(), t
    assert got[2].n_email == 0 and pii.digest(pii.findings(docs)).count() == docs.count()


def test_decontamination_cuts_once_over_all_shards(spark):
    items = spark.createDataFrame([(k, " ".join(f"{x}{i}" for i in range(12))) for k, x in enumerate("ab")], "item_id long, text string")
    one, two = (r.text for r in items.orderBy("item_id").collect())
    rest = " ".join(f"r{i}" for i in range(16))
    # The last text holds an item on both sides of another one.
    rows = [(1, f"{one} {rest} {two}", "en", "a", 1), (2, f"{one} {rest} {rest}", "en", "a", 1), (3, None, "en", "a", 1)]
    rows += [(4, f"{rest} {two[:23]} {one} {two[24:]} {rest} {rest}", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = [sorted(map(repr, decontaminate.decontaminate(docs, items, shard_words=n).collect())) for n in (1, 10**6)]
    assert got[0] == got[1] and [r.startswith("Row(doc_id=1,") for r in got[0]].count(True) == 0 and len(got[0]) == 3


def test_pii_long_runs_of_digits(spark):
    for sign in " -":
        long = "see " + sign.join("1234567890"[i % 10] for i in range(100_000)) + " and 4111 1111 1111 1111"
        rows = [(1, long + "\n4111-1111-1111-1111", "en", "a", 1), (2, "4111 1111 1111 1111 ", "en", "a", 1)]
        got = {r.doc_id: r for r in pii.findings(spark.createDataFrame(rows, DOCS)).collect()}
        assert [f.value for f in got[1].card] == ["4111 1111 1111 1111", "4111-1111-1111-1111"]
        assert [(f.start, f.end) for f in got[2].card] == [(0, 19)]


def test_pii_terms_that_reveal(spark):
    rows = [(i, f"call gandalf greyhame now bob@example.com {'often' if i % 2 else 'seldom'}\nother line", "en", "a", 1) for i in range(5)]
    rows += [(50 + i, f"call somebody now number{i} often seldom", "en", "a", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in pii.findings(docs).collect()}
    assert [(t.value, t.action) for t in found[0].terms] == [("gandalf", "remove"), ("greyhame", "remove")]
    assert found[50].terms == []
    clean = {r.doc_id: r.sanitised for r in pii.sanitise(docs).collect()}
    assert clean[0] == "call   now [EMAIL] seldom\nother line" and clean[51] == rows[6][1]


def test_pii_terms_reveal_anywhere_and_once(spark):
    rows = [(i, "ask Zebulon at z@example.com\nplain line", "en", "a", 1) for i in range(3)]
    rows += [(3, "first\nthen zebulon left", "en", "a", 1), (4, "ask xanadu at once@example.com", "en", "a", 1)]
    rows += [(50 + i, f"ask then left first number{i} plain line", "en", "a", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: [(t.start, t.value, t.action) for t in r.terms] for r in pii.findings(docs).collect()}
    assert found == {r.doc_id: [(t.start, t.value, t.action) for t in r.terms] for r in pii.findings(docs, most_bits=7).collect()}
    assert found[0] == [(4, "Zebulon", "generalise-email")] and found[3] == [(11, "zebulon", "generalise-email")]
    assert [t[:2] for t in found[4]] == [(4, "xanadu")] and found[50] == []


def told_terms(rows):
    """Terms and what they leave secret, by going through all lines of all rows."""
    n, n_e, n_t, n_te = 0, {}, {}, {}
    for _, text, *_ in rows:
        for line in dict.fromkeys((text or "").split("\n")):
            n += 1
            terms = {w.lower() for w in re.findall(r"[^\W\d_]{3,}", line)}
            found = {(p.split(":")[0], line[int(p.split(":")[1]) : int(p.split(":")[2])].lower()) for p in base_pii(line).split(",") if p}
            for t in terms:
                n_t[t] = n_t.get(t, 0) + 1
            for e in found:
                n_e[e] = n_e.get(e, 0) + 1
                for t in terms:
                    n_te[e, t] = n_te.get((e, t), 0) + 1
    left = {}
    for (e, t), k in n_te.items():
        z2, whole = 0.6745**2, n_t[t]
        p = k / whole
        low = (p + z2 / (2 * whole) - 0.6745 * math.sqrt((p * (1 - p) + z2 / (4 * whole)) / whole)) / (1 + z2 / whole)
        bits = -math.log2(low)
        if round(bits, 9) <= 1 and math.log2(n / n_e[e]) - bits >= 1:
            left[t] = min(left.get(t, 9), bits)
    return {t: ("remove" if b <= 0.33 else "generalise-email") for t, b in left.items()}


@pytest.mark.parametrize("copies", [1, 2, 20])
def test_pii_disclosures_are_brute_force(spark, copies):
    """Rows that are repeated count each time; unrelated lines change nothing."""
    rng = random.Random(6)
    names = ["Xanadu", "Ulla", "\u00c5sa", "Zeb", "Quill"]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choices(["plain", "words", "only", "here", "more", *names], k=5)) for _ in range(2)]
        if i % 3 == 0:
            k = rng.randrange(5)
            lines.append(f"{names[k]} writes {rng.choice(['often', 'now'])} from p{k}@example.com")
        rows.append((i, "\n".join(lines + lines[:1]), "en", "a", 1))
    rows += [(900, "ask Singular at once@example.org", "en", "a", 1)] * copies + [rows[3]] * (copies - 1)
    got = {}
    for unrelated in (0, 2000):
        more = [(5000 + i, f"unrelated line number {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}x", "en", "a", 1) for i in range(unrelated)]
        out = pii.findings(spark.createDataFrame(rows + more, DOCS)).collect()
        told = told_terms(rows + more)
        for r in out:
            text = dict((x[0], x[1]) for x in rows + more)[r.doc_id]
            spans = [f for k in ("email", "ip", "card", "phone") for f in r[k]]
            free = lambda m: not any(f.start < m.end() and m.start() < f.end for f in spans)
            want = [(m.start(), m.end(), m[0], told[m[0].lower()]) for m in re.finditer(r"[^\W\d_]{3,}", text) if m[0].lower() in told and free(m)]
            assert [tuple(t) for t in r.terms] == want, r.doc_id
        got[unrelated] = {r.doc_id: [tuple(t) for t in r.terms] for r in out if r.doc_id < 5000}
        assert "singular" in told and got[unrelated][900]
    assert got[0] == got[2000]


def test_pii_places_of_long_texts(spark):
    text = " ".join(f"wörd{'x' * (i % 5)}" for i in range(3000)) + " \U0001f600 end"
    got = spark.createDataFrame([(text,)], "text string").select(pii.places(F.col("text"), r"\p{L}{3,}").alias("p")).first().p
    assert [tuple(w) for w in got] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W\d_]{3,}", text)]


def test_secrets(spark, odd, none):
    rng = random.Random(3)

    def key(n, alphabet="0123456789abcdef"):
        return "".join(rng.choices(alphabet, k=n))

    rows = []
    for i in range(400):
        t = " ".join(f"plain{k}" for k in range(10)) + f" https/www.example{i}.org/path/to/page{i}/index "
        if i % 3 == 0:
            t += f'TOKEN = "{key(40)}" and AKIA{key(16, "ABCDEF0123456789")} password:x{i} ſecret=abcdefg1'
        rows.append((i, t, "en", "a", 1))
    docs = spark.createDataFrame(rows, DOCS).union(odd)
    got = {r.doc_id: r for r in secrets_scan.scan(docs).collect()}
    assert (got[0].n_assign, got[0].n_access, got[0].n_hex) == (1, 1, 1)
    assert (got[300].n_assign, got[1].n_assign, got[1].spans) == (1, 0, "")
    assert sum(r.n_model for i, r in got.items() if i is not None and i >= 7 and i % 3) == 0
    net = secrets_scan.fit(docs)
    assert net.threshold <= 1
    unknown = "see " + key(40, "0123456789abcdefABCDEF") + " there"
    assert isinstance(secrets_scan.findings(net, [unknown, None]), list)
    assert secrets_scan.redact("a token=abcdef1 b", secrets_scan.base_findings("a token=abcdef1 b")) == "a [ASSIGN] b"
    assert secrets_scan.scan(none, net).count() == 0


def test_secret_candidates():
    def of(text):
        return [text[a:b] for a, b in secrets_scan.candidates(text)]

    assert of("my pwd is xk4mq9z2. and the password protected page, api_key: 'q!w#e$r%'") == ["xk4mq9z2", "protected", "q!w#e$r%"]
    assert of("tokenization by a secretary, keyboards") == []
    assert of("see Xk4mQ9z2 or abc123 or plain1234567890123 or AbcDefGhiJklMnopQr or averylongplainwordindeed") == ["Xk4mQ9z2", "plain1234567890123", "AbcDefGhiJklMnopQr"]
    assert of("") == of("password:") == of("token " * 5) == []
    long = "aB3" * 200_000
    assert of(long + " " + "token" * 100_000 + " key" * 100_000) == [long]
    assert of("=" * 300_000 + "1" + " a" + "=" * 300_000 + "1") == ["a" + "=" * 300_000 + "1"]


def test_short_secrets_are_learnt():
    """A network sees passwords of eight characters, finds them behind a word no pattern knows, and leaves plain words alone."""
    rng = random.Random(5)
    words = "the of account reset protected business economy library manager updated yesterday before system example".split()

    def some(k):
        return " ".join(rng.choices(words, k=k))

    def password():
        return "".join(rng.choices("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=8))

    x, y = [], []
    for i in range(1200):
        more = (f" password: {password()} {some(4)}", f" password {some(2)} token {some(2)} key protected Version2 iPhone15", "")[i % 3]
        for windows, label in secrets_scan.labelled(some(8) + more, i % 2 == 0):
            assert label < 2
            x.append(windows[0])
            y.append(label)
    net = secrets_scan.train(np.array(x), np.array(y))

    def found(text):
        return any(kind == "model" for _, _, kind in secrets_scan.findings(net, [text])[0])

    assert sum(found(f"{some(6)} my pwd {password()} {some(6)}") for _ in range(200)) >= 160
    assert sum(found(f"{some(6)} my token {some(6)}") for _ in range(200)) <= 10


def test_secrets_that_are_no_candidates_count_as_missed():
    assert secrets_scan.labelled('a token="======" b', False) == [([], 2)]
    rng = np.random.default_rng(1)
    x = rng.integers(32, 127, (400, 2, secrets_scan._LENGTH))
    x[:, 1] = 1
    y = np.arange(400) % 2
    exact, loose = (secrets_scan.train(x, y, recall=0.5, missed=m) for m in (0.5, 0.0))
    assert exact.threshold <= loose.threshold


def test_base_secrets_are_those_of_the_patterns():
    """Base spans against a scan by hand, over random texts of the signs that matter."""
    rng = random.Random(7)
    pieces = ["password", "API_KEY", "apikey", "Token", '"', "'", " ", "  ", ":", "=", "abcdef", "x1", "AKIA", "ABCD1234", "0a" * 6, "0a" * 12, "\n", "é", "-"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        if rng.random() < 0.5:
            text += "".join(rng.choices(p)[0] for p in (pieces[:4], pieces[4:8], pieces[8:10], pieces[4:8], pieces[4:]))
        want = []
        at = 0
        while m := re.compile(r"(?ai:password|passwd|secret|token|api_key|apikey)").search(text, at):
            end = m.end()
            end += text[end : end + 1] in ('"', "'") and bool(text[end : end + 1])
            while text[end : end + 1] == " ":
                end += 1
            ok = text[end : end + 1] in (":", "=") and end < len(text)
            begin = end + 1
            while text[begin : begin + 1] == " ":
                begin += 1
            begin += text[begin : begin + 1] in ('"', "'") and bool(text[begin : begin + 1])
            stop = begin
            while stop < len(text) and (text[stop].isascii() and text[stop].isalnum() or text[stop] in "+/_.=-"):
                stop += 1
            if not ok or stop == begin:
                at = m.start() + 1
                continue
            if stop - begin >= 6:
                want.append((m.start(), stop, "assign"))
            at = stop
        assert [f for f in secrets_scan.base_findings(text) if f[2] == "assign"] == want, text


PAGES = {
    "<p>one<p>two <b>bold</b>\n text": "one\n\ntwo bold text",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x": "- a\n- b\n  - c\n- d\n\nx",
    '<ol start="3"><li>a</li><li>b</li></ol>': "3. a\n4. b",
    "<table><tr><th>name<th>n<tr><td>a<td>10<tr><td>long<td>2</table>": "name | n\na    | 10\nlong | 2",
    '<table><tr><td colspan=2>wide one<tr><td>a<td>b</table>': "wide one\na | b",
    "<script>if(a<b)</script><style>p{}</style>x<!-- no --><div hidden>h</div><p style='display: none'>i</p>": "x",
    "<pre>a\n  b</pre>": "a\n  b",
    "a &amp; b &lt;c&gt; &unknown; 1 < 2": "a & b <c> &unknown; 1 < 2",
    "x<br>y": "x\ny",
    "<div>a</div><div>b</div>": "a\nb",
    "</p></div>a<b>": "a",
    "<title>t</title><body>b": "b",
    "<html><head><title>t</title><p>Hello <b>you</b>": "Hello you",
    "<head>\n<meta name=a><noscript><img alt=x></noscript><script>s</script> text": "text",
    "<head><base href=a><template><p>x</template><link><style>s</style><h1>a</h1></head>b": "a\n\nb",
    "": "",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a | b\n  | c\nd | e",
    "<table><tr><td>x<td rowspan=0>y<tr><td>zz<tr><td>w</table>": "x  | y\nzz |\nw  |",
    "<table><tr><td colspan=2>a very wide one<td>end<tr><td>a<td>b<td>c</table>": "a very wide one | end\na | b           | c",
    "<table><tr><td rowspan=2 colspan=2>q<td>r<tr><td>s</table>": "q   | r\n    | s",
    "<select><option>one<option selected>two<option>three</select>!": "two\n!",
    "<select><option>one<option>two</select>": "one",
    "<select multiple><option>one<option>two</select>": "one\ntwo",
    "<svg><title>t</title><text>drawn</text><style>s</style></svg> <math><mi>x</mi><mo>=</mo><mn>1</mn></math>": "drawn x=1",
    "<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>": "yes",
    "<table style='visibility:hidden'><tr><td>n<td style='visibility:visible'>y</table>": " | y",
    "<div style='display:none'>no <b style='visibility: visible'>no</b></div>ok": "ok",
}


def test_html(spark):
    for page, text in PAGES.items():
        assert html_text.render(page) == text, page
    deep = "<div>" * 5000 + "deep"
    assert html_text.render(deep) == "deep"
    assert html_text.render("<table><tr><td>" * 5000 + "deep") == "deep"
    assert html_text.render("<ul><li>a<table><tr><td>b<table><tr><td>c<td>d</table><td>e</table>") == "- a\n\n  b     | e\n        |\n  c | d |"
    rows = spark.createDataFrame([(1, "<p>a", "u"), (2, None, None), (1, "<p>a", "u")], "page_id long, html string, text string")
    assert sorted(map(repr, map(tuple, html_text.extract(rows, columns=["page_id"]).collect()))) == ["(1, 'a')", "(1, 'a')", "(2, None)"]
    assert html_text.extract(rows.limit(0)).count() == 0


def test_secrets_are_learnt_from_all_texts(spark, monkeypatch):
    """Every candidate of every text is seen in a pass, however few there are of its kind or many in all."""
    texts = [f"line {i} token=aB{i:06d}xY and the run Zz{i:05d}qQ here" for i in range(5000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    seen, whole = [], secrets_scan._pass

    def counted(rows, *more):
        seen.append((rows.count(), rows.filter("y = 1").count()))
        return whole(rows, *more)

    monkeypatch.setattr(secrets_scan, "_pass", counted)
    net = secrets_scan.fit(docs, epochs=1)
    found = [y for i, t in enumerate(texts) for w, y in secrets_scan.labelled(t, False)]
    assert len(found) == 10_000 and sum(found) == 5000
    # Three quarters of them; the rest sets the threshold.
    assert abs(seen[0][0] - 7500) < 300 and abs(seen[0][1] - 3750) < 200
    again = secrets_scan.fit(docs, epochs=1)
    assert net.threshold == again.threshold and all((p == q).all() for p, q in zip(net.parts, again.parts))


def test_told_terms_meet_the_words_without_a_shuffle(spark):
    """A measured small table of terms is broadcast, whatever limit Spark's own estimate has."""
    docs = spark.createDataFrame([(i, f"call anna{i % 3}x at anna{i % 3}@mail.org now") for i in range(40)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in pii.findings(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
