"""Tables to graph triples ``(s, p, o, o_kind, o_datatype)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, LongType

from .. import vocabulary
from ..functions.numeric import whole_number
from ..functions.text import float_text, underscored


@dataclass(frozen=True)
class Form:
    """The fixed part of a triple: all of it but the two local texts."""

    subject: str
    predicate: str
    object: str = ""
    kind: str = "iri"
    datatype: str | None = None


@dataclass(frozen=True)
class Statement:
    """One triple per input row: a form, filled with a subject and an object text."""

    form: Form
    subject: Column
    object: Column


def triples_of(*sources: tuple[DataFrame, Sequence[Statement]]) -> DataFrame:
    """The set of triples that the statements make of the rows of each source.

    Every source is scanned once. Rows become ``(form number, subject, object text, object number)``, each
    object as the text or number that it is in the table; only these short rows are merged, first within each task and
    then in one shuffle, and the distinct ones are spelled out as texts and IRIs. A class
    triple that each row repeats so travels once per task. Statements with a
    missing subject or object are left out.
    """
    forms = list(dict.fromkeys(s.form for _, statements in sources for s in statements))
    short = reduce(DataFrame.unionAll, [_short(df, statements, forms) for df, statements in sources])
    spelled = _spell_out(short.distinct(), forms)
    return spelled.distinct() if any(_may_coincide(a, b) for a, b in combinations(forms, 2)) else spelled


def triples_from(df: DataFrame, statements: Sequence[Statement]) -> DataFrame:
    """The set of triples of one source."""
    return triples_of((df, statements))


def union_triples(*parts: DataFrame) -> DataFrame:
    """Union of triple sets, again a set."""
    return reduce(DataFrame.unionByName, parts).distinct()


def _short(df: DataFrame, statements: Sequence[Statement], forms: Sequence[Form]) -> DataFrame:
    types = [f.dataType for f in df.select(*[s.object.alias(f"_{i}") for i, s in enumerate(statements)]).schema]
    filled = [
        F.struct(F.lit(forms.index(s.form)).alias("form"), s.subject.cast("string").alias("subject"), *_typed(s.object, t))
        for s, t in zip(statements, types)
    ]
    # The array is made in a projection of its own, where texts used twice are computed once.
    rows = df.select(F.array(*filled).alias("t")).select(F.inline("t"))
    return rows.where(F.col("subject").isNotNull() & (F.col("object").isNotNull() | F.col("whole").isNotNull() | F.col("number").isNotNull()))


def _typed(c: Column, kind: DataType) -> list[Column]:
    """An object as ``object`` (text), ``whole`` or ``number``: numbers become text once a distinct one, not once a row."""
    text, whole, number = F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit(None).cast("double")
    if isinstance(kind, LongType):
        whole = c
    elif isinstance(kind, DoubleType):
        # The two zeros are one value to a grouping, but two texts.
        text, number = F.when(c == 0, c.cast("string")), c
    else:
        text = c.cast("string")
    return [text.alias("object"), whole.alias("whole"), number.alias("number")]


def _spell_out(short: DataFrame, forms: Sequence[Form]) -> DataFrame:
    def fixed(name: str) -> Column:
        values = F.array(*[F.lit(getattr(form, name)).cast("string") for form in forms])
        return F.get(values, F.col("form"))

    short = short.select("form", "subject", F.coalesce("object", F.col("whole").cast("string"), F.col("number").cast("string")).alias("object"))
    text = F.when(fixed("datatype") == vocabulary.XSD_DOUBLE, float_text(F.col("object"))).otherwise(F.col("object"))
    return short.select(
        F.concat(fixed("subject"), F.col("subject")).alias("s"),
        fixed("predicate").alias("p"),
        F.concat(fixed("object"), text).alias("o"),
        fixed("kind").alias("o_kind"),
        fixed("datatype").alias("o_datatype"),
    )


def _may_coincide(a: Form, b: Form) -> bool:
    """True if two different forms could spell the same triple."""

    def overlap(x: str, y: str) -> bool:
        return x.startswith(y) or y.startswith(x)

    return (
        (a.predicate, a.kind, a.datatype) == (b.predicate, b.kind, b.datatype)
        and overlap(a.subject, b.subject)
        and overlap(a.object, b.object)
    )


class Entity:
    """A kind of subject, named by a column: ``<namespace><kind>/<name>``."""

    def __init__(self, ns: str, kind: str, name: Column):
        self.prefix, self.name = f"{ns}{kind}/", underscored(name)

    def is_a(self, class_iri: str) -> Statement:
        return Statement(Form(self.prefix, vocabulary.RDF_TYPE, class_iri), self.name, F.lit(""))

    def relates(self, predicate: str, other: Entity) -> Statement:
        return Statement(Form(self.prefix, predicate, other.prefix), self.name, other.name)

    def has_text(self, predicate: str, value: Column) -> Statement:
        return Statement(Form(self.prefix, predicate, kind="literal"), self.name, value)

    def has_integer(self, predicate: str, value: Column) -> Statement:
        form = Form(self.prefix, predicate, kind="literal", datatype=vocabulary.XSD_INTEGER)
        return Statement(form, self.name, whole_number(value))

    def has_double(self, predicate: str, value: Column) -> Statement:
        form = Form(self.prefix, predicate, kind="literal", datatype=vocabulary.XSD_DOUBLE)
        return Statement(form, self.name, value.cast("double"))


def surveillance_statements(ns: str = vocabulary.NAMESPACE) -> list[Statement]:
    """Counts hang on the place alone, so equal counts of a place coincide."""
    place = Entity(ns, "district", F.col("district_canonical"))
    disease = Entity(ns, "disease", F.col("disease"))
    return [
        place.is_a(ns + "District"),
        disease.is_a(ns + "Disease"),
        place.relates(ns + "hasDisease", disease),
        place.has_integer(ns + "caseCount", F.col("case_count")),
    ]


def weather_statements(ns: str = vocabulary.NAMESPACE) -> list[Statement]:
    place = Entity(ns, "district", F.col("district_canonical"))
    return [
        place.has_double(ns + "temperature", F.col("temperature_c")),
        place.has_double(ns + "humidity", F.col("humidity_pct")),
    ]


def alert_statements(ns: str = vocabulary.NAMESPACE) -> list[Statement]:
    place = Entity(ns, "district", F.col("district_canonical"))
    disaster = Entity(ns, "disaster", F.col("event_type"))
    return [
        disaster.is_a(ns + "Disaster"),
        place.relates(ns + "hasDisaster", disaster),
        place.has_text(ns + "severity", F.col("severity")),
    ]


def policy_statements(ns: str = vocabulary.NAMESPACE) -> list[Statement]:
    policy = Entity(ns, "policy", F.col("title"))
    return [
        policy.is_a(ns + "Policy"),
        policy.has_text(ns + "title", F.col("title")),
        policy.has_text(ns + "status", F.col("status")),
    ]


def knowledge_graph(
    cases: DataFrame,
    weather: DataFrame,
    alerts: DataFrame,
    policy: DataFrame,
    ns: str = vocabulary.NAMESPACE,
) -> DataFrame:
    """All triples of the four harmonised tables."""
    return triples_of(
        (cases, surveillance_statements(ns)),
        (weather, weather_statements(ns)),
        (alerts, alert_statements(ns)),
        (policy, policy_statements(ns)),
    )
