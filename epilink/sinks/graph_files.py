"""Triples as N-Triples, Turtle and RDF/XML files.

Turtle and RDF/XML pass over the triples twice (to sort them, and for their predicates), so give
them a stored or settled graph. RDF/XML 1.0 has no way to write most control characters.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocabulary
from ..functions.text import exponent_text
from ..sources.ntriples import BACKSLASH, QUOTE


def _spelled(c: Column, characters: list[str]) -> Column:
    """These characters as ``\\uXXXX``; text without them is only looked at once."""
    out = c
    for x in characters:
        out = F.replace(out, F.lit(x), F.lit(f"\\u{ord(x):04X}"))
    return F.when(c.rlike(_any_of(characters)), out).otherwise(c)


def _any_of(characters: list[str]) -> str:
    return "[" + "".join(f"\\x{{{ord(x):x}}}" for x in characters) + "]"


_CONTROLS = [*map(chr, range(32)), BACKSLASH, QUOTE]
# The backslash comes first, as the others are spelled with one.
_NOT_IN_IRIS = ["\\", *'<>"{}|^` ', *_CONTROLS]


def _escape(c: Column) -> Column:
    out = c
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    # The other controls are not among the characters that were put in, so the raw text tells whether there are any.
    rare = [x for x in _CONTROLS if x not in "\n\r\t"]
    plain = ~c.rlike(_any_of(["\\", '"', *_CONTROLS]))
    return F.when(plain, c).when(c.rlike(_any_of(rare)), _spelled(out, rare)).otherwise(out)


def _iri(c: Column) -> Column:
    """An IRI in angle brackets; a blank node as it is."""
    return F.when(F.startswith(c, F.lit("_:")), c).otherwise(F.concat(F.lit("<"), _spelled(c, _NOT_IN_IRIS), F.lit(">")))


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One statement per row in ``value``."""
    literal = F.concat(
        F.lit('"'),
        _escape(F.col("o")),
        F.lit('"'),
        F.when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^"), _iri(F.col("o_datatype")))).otherwise(F.lit("")),
    )
    term = F.when(F.col("o_kind") == "iri", _iri(F.col("o"))).otherwise(literal)
    return triples.select(
        F.concat_ws(" ", _iri(F.col("s")), _iri(F.col("p")), term, F.lit(".")).alias("value")
    )


def write_ntriples(triples: DataFrame, path: str) -> str:
    ntriples_lines(triples).write.mode("overwrite").text(path)
    return path


def _short(c: Column, ns: str) -> Column:
    """``ex:name`` for a plain name right below the namespace, else the whole IRI."""
    rest = F.substr(c, F.lit(len(ns) + 1))
    plain = F.startswith(c, F.lit(ns)) & rest.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$")
    return F.when(plain, F.concat(F.lit("ex:"), rest)).otherwise(_iri(c))


def _digits(c: Column) -> Column:
    """The digits of a number without sign, point, exponent and outer zeros."""
    return F.regexp_replace(F.regexp_replace(c, r"^-|[eE].*$|\.", ""), r"^0+|0+$", "")


def _power(size: Column) -> Column:
    """The power of ten of a number that is not negative."""
    power = F.when(size == 0, F.lit(0)).otherwise(F.floor(F.log10(size)))
    # log10 may round up to a power of ten that the value does not reach.
    return F.when((size > 0) & (F.pow(F.lit(10.0), power) > size), power - 1).otherwise(power)


def _scientific(c: Column, digits: Column, power: Column) -> Column:
    """A double as Turtle writes it: ``3.46e+01``, ``4e+01``."""
    mantissa = F.when(digits == "", F.lit("0")).when(F.length(digits) == 1, digits).otherwise(
        F.concat(F.left(digits, F.lit(1)), F.lit("."), F.substr(digits, F.lit(2)))
    )
    return F.concat(
        F.when(F.startswith(c, F.lit("-")), F.lit("-")).otherwise(F.lit("")),
        mantissa,
        exponent_text(power),
    )


def turtle_blocks(triples: DataFrame, ns: str = vocabulary.NAMESPACE) -> DataFrame:
    """One row ``(s, place, verb, number, term, value)`` per statement; ``place`` puts the type first.

    Every statement is a block of its own, so that a subject may have any number of them.
    """
    o = F.col("o")
    quoted = F.concat(F.lit('"'), _escape(o), F.lit('"'))
    is_double = F.col("o_datatype") == vocabulary.XSD_DOUBLE
    number = F.when(F.col("o_datatype").isin(vocabulary.XSD_INTEGER, vocabulary.XSD_DOUBLE), o.try_cast("double"))
    # Columns of their own, as each is looked at several times.
    measured = triples.withColumns({"number": number, "_digits": F.when(is_double, _digits(o))})
    measured = measured.withColumn("_power", F.when(is_double, _power(F.abs("number"))))
    term = (
        F.when(F.col("o_kind") == "iri", _short(o, ns))
        .when(F.col("o_datatype").isNull(), quoted)
        .when(F.col("o_datatype") == vocabulary.XSD_INTEGER, o)
        .when(is_double & o.rlike(r"\d"), _scientific(o, F.col("_digits"), F.col("_power")))
        .otherwise(F.concat(quoted, F.lit("^^"), _iri(F.col("o_datatype"))))
    )
    is_type = F.col("p") == vocabulary.RDF_TYPE
    rows = measured.select(
        "s",
        F.when(is_type, 0).otherwise(1).alias("place"),
        F.when(is_type, F.lit("a")).otherwise(_short(F.col("p"), ns)).alias("verb"),
        "number",
        term.alias("term"),
    )
    return rows.withColumn("value", F.concat_ws(" ", _iri(F.col("s")), "verb", "term", F.lit(".")))


def write_turtle(triples: DataFrame, path: str, ns: str = vocabulary.NAMESPACE) -> str:
    """Turtle files sorted by subject; every file starts with the prefixes and stands alone."""
    prefixes = f"@prefix ex: <{ns}> .\n@prefix xsd: <{vocabulary.XSD_NAMESPACE}> .\n\n"
    ordered = turtle_blocks(triples, ns).orderBy("s", "place", "verb", "number", "term")
    # The low 33 bits count the rows of a partition, so they are zero on its first row.
    row_in_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    headed = ordered.select(
        F.when(row_in_file == 0, F.concat(F.lit(prefixes), F.col("value"))).otherwise(F.col("value")).alias("value")
    )
    headed.write.mode("overwrite").text(path)
    return path


def predicate_tags(predicates: Sequence[str], ns: str) -> tuple[dict[str, str], dict[str, str]]:
    """Prefixed names of predicates, and the namespaces of the prefixes."""
    spaces = {ns: "ex", vocabulary.RDF_NAMESPACE: "rdf"}
    tags = {}
    for p in sorted(predicates):
        name = re.search(r"[A-Za-z_][A-Za-z0-9_.-]*$", p)
        if name is None or name.start() == 0:
            raise ValueError(f"no XML name for the predicate {p!r}")
        space = p[: name.start()]
        tags[p] = f"{spaces.setdefault(space, f'ns{len(spaces) - 1}')}:{name[0]}"
    return tags, {prefix: space for space, prefix in spaces.items()}


def predicates_of(triples: DataFrame) -> list[str]:
    """The distinct predicates, a vocabulary: they become the columns of the RDF/XML table."""
    return sorted(row.p for row in triples.select("p").distinct().toLocalIterator())


def rdfxml_rows(triples: DataFrame, tags: dict[str, str]) -> DataFrame:
    """One row per statement: the subject, and the object in the column of its predicate's tag.

    ``tags`` names every predicate; rows of a subject need not be in one place.
    """
    is_iri, blank = F.col("o_kind") == "iri", F.startswith("o", F.lit("_:"))
    label = lambda c: F.substr(c, F.lit(3))
    term = F.struct(
        F.when(is_iri & ~blank, F.col("o")).alias("_rdf:resource"),
        F.when(is_iri & blank, label(F.col("o"))).alias("_rdf:nodeID"),
        F.col("o_datatype").alias("_rdf:datatype"),
        F.when(~is_iri, F.col("o")).alias("_VALUE"),
    )
    anonymous = F.startswith("s", F.lit("_:"))
    return triples.select(
        F.when(~anonymous, F.col("s")).alias("_rdf:about"),
        F.when(anonymous, label(F.col("s"))).alias("_rdf:nodeID"),
        *[F.when(F.col("p") == p, term).alias(tag) for p, tag in tags.items()],
    )


def write_rdfxml(triples: DataFrame, path: str, ns: str = vocabulary.NAMESPACE) -> str:
    """RDF/XML files with all statements, each file a document of its own."""
    tags, spaces = predicate_tags(predicates_of(triples), ns)
    root = " ".join(["rdf:RDF", *[f'xmlns:{prefix}="{space}"' for prefix, space in spaces.items()]])
    (
        rdfxml_rows(triples, tags)
        .write.mode("overwrite")
        .format("xml")
        .option("rootTag", root)
        .option("rowTag", "rdf:Description")
        .option("declaration", 'version="1.0" encoding="utf-8"')
        .option("validateName", "false")
        .save(path)
    )
    return path
