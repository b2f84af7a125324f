"""Personal data and the terms that reveal it, in DataFrame operations only.

Fixed patterns find e-mail addresses, IP addresses, card and phone numbers: the protected entities.
A term (a word of three or more letters, lower-cased) reveals an entity as far as lines that hold the term hold the
entity. Let ``p`` be the lower Wilson bound, at ``BOUND`` standard deviations, of the share of the lines with the term in which the
entity stands too. Without the term ``log2(n / n_e)`` bits are needed to name the entity of a line, with it ``-log2(p)``, so these
bits are what the term leaves secret. Few lines tell less; there is no least number of lines, entities seen once are judged
too, and the threshold is the same at every size of the corpus, since unrelated lines change neither ``n_te`` nor ``n_t``.
Counts are of lines of the whole corpus: each line of a document once, in every row that holds it. In all lines of all
documents, also those without the entity, terms that leave at most ``GENERALISE`` bits are generalised (replaced by the
kind of entity they reveal) and those that leave at most ``REMOVE`` bits are removed, if they tell at least ``TELLS`` bits.

Texts are read three times: for entities and their lines, for the lines of each word, and for the places of told terms.
The last pass looks for those words of a row only whose hash is in a bit filter of the told terms; of these only places are
shuffled, to meet the terms themselves. The filter, which the driver sets up, has ``FILTER_BITS`` bits for a term, at most 2^``MOST_BITS`` (2 MB); a fuller
one lets more places through and loses none.

Defined cases: a null text counts as empty and has no findings; findings of one kind never
overlap, those of different kinds may; terms that overlap a base finding are left to it; repeated
rows are found alike and count as documents of their own; empty tables give empty tables.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epilink.llm.tables import row_key, stored
from epilink.operators.lookup import broadcast_if_small

# What a base finding looks like, in the order in which kinds are listed. Runs that
# cannot be cut differently are possessive, and begin where they can (``\G``: after the last match).
# A repeated group must be possessive: Java matches any other by recursion, which long runs overflow.
KINDS = ("email", "ip", "card", "phone")
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: A character that no pattern can match stands for the mark while the matches are marked.
_MARK, _OTHER = "\x01", "\x02"

#: Half of all true shares lie within the bound and its upper twin.
BOUND = 0.6745
#: Bits left: one is an even chance to name the entity, a third of a bit four chances in five.
GENERALISE, REMOVE, TELLS = 1.0, 0.33, 1.0
_TERM = r"\p{L}{3,}"
#: Bits of the filter for each told term, and the binary logarithm of the most it may have.
FILTER_BITS, MOST_BITS = 16, 24


def _clean(text_col: str) -> Column:
    """The text without the mark, at its length; null as empty."""
    return F.replace(F.coalesce(text_col, F.lit("")), F.lit(_MARK), F.lit(_OTHER))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Whether the digits of ``s`` pass the Luhn check: every second one from the right counts double."""
    values = F.transform(F.split(F.reverse(_digits(s)), ""), lambda c, i: _luhn_value(c.cast("int"), i))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _luhn_value(d: Column, i: Column) -> Column:
    double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.when(i % 2 == 1, double).otherwise(d)


_HOLDS = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda s: (F.length(_digits(s)) <= 19) & _luhn(s),
    "phone": lambda s: F.length(_digits(s)).between(10, 15),
}
#: What a text must hold to be searched for a kind at all.
_HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}

_NONE = "array<struct<start:int,end:int,value:string>>"
#: Pieces that are gathered at a time, as an array is copied when it grows; even, so that each part begins outside a match.
_PIECES = 256


def places(text: Column, pattern: str | Column) -> Column:
    """Matches of ``pattern`` as ``array<struct<start, end, value>>`` in code points; ``text`` must not hold the mark."""
    whole = F.concat(F.lit("("), pattern, F.lit(")")) if isinstance(pattern, Column) else F.lit(f"({pattern})")
    pieces = F.split(F.regexp_replace(text, whole, F.lit(f"{_MARK}$1{_MARK}")), _MARK)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(_NONE).alias("found"))

    def step(s, p):
        end = s["at"] + F.length(p)
        hit = F.array(F.struct(s["at"].alias("start"), end.alias("end"), p.alias("value")))
        return F.struct(end.alias("at"), (~s["inside"]).alias("inside"), F.when(s["inside"], F.concat(s["found"], hit)).otherwise(s["found"]).alias("found"))

    def part(all_, k):
        return F.aggregate(F.slice(all_, k + 1, F.lit(_PIECES)), start, step, lambda s: F.struct(s["at"].alias("size"), s["found"].alias("found")))

    def join(s, p):
        return F.struct((s["at"] + p["size"]).alias("at"), F.concat(s["parts"], F.array(F.struct(s["at"].alias("at"), p["found"].alias("found")))).alias("parts"))

    def shifted(g):
        return F.transform(g["found"], lambda f: F.struct((g["at"] + f["start"]).alias("start"), (g["at"] + f["end"]).alias("end"), f["value"].alias("value")))

    # The array of one element names the pieces, which would be made anew for each part otherwise.
    parts = F.flatten(F.transform(F.array(pieces), lambda a: F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(_PIECES)), lambda k: part(a, k))))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,found:{_NONE}>>").alias("parts"))
    return F.aggregate(parts, none, join, lambda s: F.flatten(F.transform(s["parts"], shifted)))


def _base(kind: str, text: Column) -> Column:
    hint = text.contains(_HINT[kind]) if _HINT[kind] else F.lit(True)
    some = hint & text.rlike(_PATTERNS[kind])
    return F.when(some, F.filter(places(text, _PATTERNS[kind]), lambda f: _HOLDS[kind](f["value"]))).otherwise(F.array().cast(_NONE))


def base_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``_text`` and one array of findings for each kind."""
    text = _clean(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    return rows.select("doc_id", "_text", *(_base(k, F.col("_text")).alias(k) for k in KINDS))


def _words(line: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(_TERM), 0), F.lower))


_MENTIONS = "array<struct<kind:string,entity:string,line:string>>"


def _mentions() -> Column:
    """Each entity in each different line of the row that holds it."""

    def of(kind: str) -> Column:
        def mention(f: Column) -> Column:
            head = F.substring_index(F.substring(F.col("_text"), F.lit(1), f["start"]), "\n", -1)
            tail = F.substring_index(F.substring(F.col("_text"), f["start"] + 1, F.length("_text")), "\n", 1)
            entity = _digits(f["value"]) if kind in ("card", "phone") else F.lower(f["value"])
            return F.struct(F.lit(kind).alias("kind"), entity.alias("entity"), F.concat(head, tail).alias("line"))

        return F.transform(kind, mention)

    some = reduce(lambda x, y: x | y, (F.size(k) > 0 for k in KINDS))
    return F.when(some, F.array_distinct(F.concat(*map(of, KINDS)))).otherwise(F.array().cast(_MENTIONS))


def _lower_bound(part: Column, whole: Column) -> Column:
    """The lower Wilson bound of a share; above 0 if ``part`` is."""
    p, z2 = part / whole, BOUND * BOUND
    return (p + z2 / (2 * whole) - BOUND * F.sqrt((p * (1 - p) + z2 / (4 * whole)) / whole)) / (1 + z2 / whole)


def disclosures(docs: DataFrame, found: DataFrame, text_col: str = "text", generalise: float = GENERALISE) -> DataFrame:
    """``(kind, entity, term, left)`` of terms that leave at most ``generalise`` bits; ``found`` has ``mentions`` of all rows."""
    lines = found.select(F.explode("mentions").alias("m")).select("m.*")
    entities = lines.groupBy("kind", "entity").agg(F.count("*").alias("n_e"))
    both = lines.select("kind", "entity", F.explode(_words(F.col("line"))).alias("term"))
    both = both.groupBy("kind", "entity", "term").agg(F.count("*").alias("n_te"))
    both = stored(both.join(entities, ["kind", "entity"]), "pairs")
    text_lines = docs.select(F.explode(F.array_distinct(F.split(_clean(text_col), "\n"))).alias("line"))
    counts = text_lines.select(F.explode(_words(F.col("line"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n = found.agg(F.sum("n_lines")).first()[0] or 1
    judged = both.join(counts, "term").withColumn("left", F.round(-F.log2(_lower_bound(F.col("n_te"), F.col("n_t"))), 9))
    tells = F.log2(F.lit(float(n)) / F.col("n_e")) - F.col("left") >= TELLS
    return judged.filter((F.col("left") <= generalise) & tells).select("kind", "entity", "term", "left")


def _bit(term: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(term), 64 - bits)


def _filter_of(told: DataFrame, bits: int) -> Column:
    """2^``bits`` bits as a constant array of longs, those of the hashes of ``term`` set."""
    bit = _bit(F.col("term"), bits)
    mask = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    held = told.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(mask).alias("mask"))
    longs = np.zeros(1 << (bits - 6), dtype=np.int64)
    found = held.toArrow()
    longs[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return F.from_json(F.lit(str(longs.tolist())), "array<bigint>")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: float = REMOVE, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id``, the arrays ``email, ip, card, phone`` and ``terms`` (start, end, value and action) of every row."""
    row = row_key("doc_id", F.md5("_text"))
    base = base_findings(docs, id_col, text_col)
    n_lines = F.size(F.array_distinct(F.split("_text", "\n")))
    base = stored(base.select("doc_id", row.alias("_row"), *KINDS, _mentions().alias("mentions"), n_lines.alias("n_lines")), "base")
    told = disclosures(docs, base, text_col).groupBy("term").agg(F.min("left").alias("left"), F.min("kind").alias("kind"))
    action = F.when(F.col("left") <= remove, F.lit("remove")).otherwise(F.concat(F.lit("generalise-"), F.col("kind")))
    told = stored(told.select("term", action.alias("action")), "told")
    bits = min(most_bits, max(7, (told.count() * FILTER_BITS).bit_length()))
    held = _filter_of(told, bits)

    def may_be_told(word: Column) -> Column:
        bit = _bit(F.lower(word), bits)
        return F.getbit(F.get(held, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1

    # The different words of a row that may be told, as they are spelled, and where they stand.
    texts = docs.select(F.col(id_col).alias("doc_id"), _clean(text_col).alias("_text"))
    words = F.filter(F.array_distinct(F.regexp_extract_all("_text", F.lit(_TERM), 0)), may_be_told)
    texts = texts.select("doc_id", "_text", words.alias("_words")).filter("size(_words) > 0")
    alone = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join("_words", "|"), F.lit(r")(?!\p{L})"))
    spots = texts.select(row.alias("_row"), places(F.col("_text"), alone).alias("at")).select("_row", F.explode("at").alias("w"))
    spots = spots.withColumn("term", F.lower("w.value")).join(broadcast_if_small(told), "term")
    # A set, as a row that is repeated finds the same places each time.
    hits = spots.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("w.start", "w.end", "w.value", "action"))).alias("_terms"))
    out = base.drop("mentions", "n_lines").join(hits, "_row", "left")
    all_base = F.concat(*KINDS)
    apart = F.filter("_terms", lambda t: ~F.exists(all_base, lambda f: (f["start"] < t["end"]) & (t["start"] < f["end"])))
    none = F.array().cast("array<struct<start:int,end:int,value:string,action:string>>")
    return out.select("doc_id", "_row", *KINDS, F.when(F.col("_terms").isNull(), none).otherwise(apart).alias("terms"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from those of :func:`findings`."""

    def spans(column: str, rank: int, kind) -> Column:
        return F.transform(column, lambda f: F.struct(f["start"].alias("start"), F.lit(rank).alias("rank"), F.concat_ws(":", kind(f), f["start"], f["end"]).alias("t")))

    base = [spans(k, i, lambda f, k=k: F.lit(k)) for i, k in enumerate(KINDS)]
    terms = spans("terms", len(KINDS), lambda f: f["action"])

    def spelled(arrays: list[Column]) -> Column:
        return F.array_join(F.transform(F.array_sort(F.concat(*arrays)), lambda s: s["t"]), ",")

    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled([*base, terms]).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``sanitised``: base findings and generalised terms as kinds in brackets, removed terms gone; null stays null."""
    found = findings(docs, id_col, text_col).dropDuplicates(["_row"])

    def replaced(kind: str) -> Column:
        return F.transform(kind, lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("put")))

    marks = F.concat(
        *map(replaced, KINDS),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["action"] == "remove", F.lit("")).otherwise(F.upper(F.concat(F.lit("["), F.substring_index(t["action"], "-", -1), F.lit("]")))).alias("put"))),
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_plain"), F.md5(_clean(text_col)).alias("_hash"))
    rows = rows.withColumn("_row", row_key("doc_id", "_hash")).join(found.select("_row", F.array_sort(marks).alias("marks")), "_row", "left")
    start = F.struct(F.lit(0).alias("done"), F.lit("").alias("out"))

    def step(s, m):
        fresh = m["start"] >= s["done"]
        between = F.substring(F.col("_plain"), s["done"] + 1, m["start"] - s["done"])
        return F.struct(F.greatest(s["done"], m["end"]).alias("done"), F.when(fresh, F.concat(s["out"], between, m["put"])).otherwise(s["out"]).alias("out"))

    whole = F.aggregate("marks", start, step, lambda s: F.concat(s["out"], F.substring(F.col("_plain"), s["done"] + 1, F.length("_plain"))))
    return rows.select("doc_id", F.when(F.col("_plain").isNotNull(), F.when(F.size("marks") > 0, whole).otherwise(F.col("_plain"))).alias("sanitised"))
