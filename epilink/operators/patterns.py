"""Graph patterns over triples as filters and equi-joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .. import vocabulary
from ..functions.text import local_name

Pattern = tuple[str, str, str]


def _is_variable(term: str) -> bool:
    return term.startswith("?")


def _constant(term: str) -> tuple[str, str, str | None]:
    """Value, kind and datatype of a constant; only the outer quotes are not part of the text."""
    if not term.startswith('"'):
        return term, "iri", None
    text, _, datatype = term.rpartition('"^^<')
    if text and datatype.endswith(">"):
        return text[1:], "literal", datatype[:-1]
    return term[1:-1], "literal", None


def _variables(pattern: Pattern) -> list[str]:
    return list(dict.fromkeys(t for t in pattern if _is_variable(t)))


def _plain(patterns: Sequence[Pattern]) -> set[str]:
    """Variables whose text says all: those that are an IRI by their place in some pattern, and those that no join compares."""
    always_iri = {t for s, p, _ in patterns for t in (s, p)}
    uses = [t for pattern in patterns for t in pattern]
    return {t for t in uses if _is_variable(t) and (t in always_iri or uses.count(t) == 1)}


def _match(triples: DataFrame, pattern: Pattern, plain: set[str], joined: set[str]) -> DataFrame:
    """Bindings of one pattern: a column per variable, holding its text if it is ``plain``, else the whole term.

    A constant in quotes is a plain literal, one in quotes followed by ``^^<type>``
    a typed literal, any other constant an IRI.
    """
    whole = F.struct(F.col("o").alias("value"), F.col("o_kind").alias("kind"), F.coalesce("o_datatype", F.lit("")).alias("datatype"))
    matched, bound = triples, {}
    for position, term in zip("spo", pattern, strict=True):
        if not _is_variable(term):
            value, kind, datatype = _constant(term)
            matched = matched.where(F.col(position) == value)
            if position == "o":
                matched = matched.where((F.col("o_kind") == kind) & F.col("o_datatype").eqNullSafe(F.lit(datatype)))
            continue
        column = F.col(position) if position != "o" or term in plain else whole
        if position == "o" and term in plain and term in joined:
            # It meets an IRI somewhere, so it must be one.
            matched = matched.where(F.col("o_kind") == "iri")
        if term in bound:
            matched = matched.where(bound[term] == column)
        else:
            bound[term] = column
    return matched.select(*[column.alias(variable[1:]) for variable, column in bound.items()])


@dataclass(frozen=True)
class PredicateStatistics:
    """Triples of a predicate and how many different subjects and objects they have."""

    rows: float
    subjects: float
    objects: float


def statistics_of(triples: DataFrame) -> dict[str, PredicateStatistics]:
    """Statistics of each predicate; a vocabulary, so one row each comes to the driver."""
    counted = triples.groupBy("p").agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("s").alias("subjects"), F.approx_count_distinct("o").alias("objects")
    )
    return {r.p: PredicateStatistics(r.rows, r.subjects, r.objects) for r in counted.collect()}


def _size(pattern: Pattern, statistics: Mapping[str, PredicateStatistics]) -> tuple[float, dict[str, float]]:
    """Estimated bindings of a pattern, and how many values each of its variables has."""
    s, p, o = pattern
    if _is_variable(p):
        own = list(statistics.values())
        found = PredicateStatistics(sum(x.rows for x in own), sum(x.subjects for x in own), sum(x.objects for x in own))
    else:
        found = statistics.get(p, PredicateStatistics(0, 0, 0))
    rows = found.rows
    if not _is_variable(s):
        rows /= max(found.subjects, 1)
    if not _is_variable(o):
        rows /= max(found.objects, 1)
    if s == o:
        rows /= max(found.subjects, found.objects, 1)
    values = {p: len(statistics)} | {o: found.objects} | {s: found.subjects}
    return rows, {t: max(min(v, rows), 1.0) for t, v in values.items() if _is_variable(t)}


def join_order(patterns: Sequence[Pattern], statistics: Mapping[str, PredicateStatistics] | None = None) -> list[Pattern]:
    """The patterns in the order in which they are joined; each shares a variable with those before it.

    With statistics the pattern with the fewest bindings comes first, then always the one that leaves the fewest rows,
    so the written order does not matter. Without, the written order is kept as far as variables are shared.
    """
    pending = list(patterns)
    if statistics is None:
        order = [pending.pop(0)]
    else:
        pending.sort(key=lambda p: (_size(p, statistics)[0], p))
        order = [pending.pop(0)]
        rows, values = _size(order[0], statistics)
    while pending:
        known = {v for p in order for v in _variables(p)}
        linked = [p for p in pending if known & set(_variables(p))]
        if not linked:
            raise ValueError("patterns without a shared variable would need a cross product")
        chosen = linked[0]
        if statistics is not None:

            def joined(pattern: Pattern) -> float:
                own_rows, own = _size(pattern, statistics)
                out = rows * own_rows
                for v in own:
                    if v in values:
                        out /= max(values[v], own[v])
                return out

            chosen = min(linked, key=lambda p: (joined(p), p))
            rows, own = joined(chosen), _size(chosen, statistics)[1]
            values = {v: max(min(values.get(v, own.get(v)), own.get(v, values.get(v)), rows), 1.0) for v in values | own}
        pending.remove(chosen)
        order.append(chosen)
    return order


def bgp(
    triples: DataFrame,
    patterns: Sequence[Pattern],
    select: Sequence[str] | None = None,
    statistics: Mapping[str, PredicateStatistics] | None = None,
) -> DataFrame:
    """Solutions of a basic graph pattern: one row per way to match every pattern.

    Patterns are joined on the variables they share; every pattern must share one with others, as the patterns would
    otherwise be multiplied. ``statistics`` choose the order of the joins. A variable that can only be an IRI is
    joined by its text, any other by text, kind and datatype.
    """
    order = join_order(patterns, statistics)
    plain = _plain(patterns)
    uses = [t for pattern in patterns for t in pattern]
    joined = {t for t in uses if _is_variable(t) and uses.count(t) > 1}
    result = _match(triples, order[0], plain, joined)
    for pattern in order[1:]:
        bindings = _match(triples, pattern, plain, joined)
        result = result.join(bindings, [c for c in result.columns if c in bindings.columns])
    names = list(select or dict.fromkeys(v[1:] for p in patterns for v in _variables(p)))
    return result.select(*[F.col(n if f"?{n}" in plain else f"{n}.value").alias(n) for n in names])


def policy_status(
    triples: DataFrame, ns: str = vocabulary.NAMESPACE, statistics: Mapping[str, PredicateStatistics] | None = None
) -> DataFrame:
    """Local name and status of every policy."""
    found = bgp(
        triples,
        [("?policy", vocabulary.RDF_TYPE, ns + "Policy"), ("?policy", ns + "status", "?status")],
        statistics=statistics,
    )
    return found.select(local_name(F.col("policy")).alias("policy"), "status")
