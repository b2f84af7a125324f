"""Reading triples back from N-Triples text, one statement per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Stand-ins for an escaped backslash and an escaped quote while a line is cut into its parts, so that
# the next quote always closes a literal. Neither may stand in a file: writers escape them.
BACKSLASH, QUOTE = "\ufdd0", "\ufdd1"

_NODE = r'<[^>\x00-\x1F]*>|_:[^\s<>"]*[^\s<>".]'
_STATEMENT = (
    rf'^\s*({_NODE})\s*<([^>\x00-\x1F]*)>\s*(?:({_NODE})|"([^"]*)"(?:\^\^<([^>\x00-\x1F]*)>|@[A-Za-z0-9-]+)?)\s*\.\s*(?:#[^\n]*)?$'
)
# Field separator that no IRI may hold; the literal comes last, so it may hold anything.
_SEPARATOR = "\u0001"
_FIELDS = _SEPARATOR.join(["$1", "$2", "$3", "$5", "$4"])

# Code points in eight digits; halves of a pair are none.
_LONG = r"\\U(?:0000(?![Dd][89A-Fa-f])[0-9A-Fa-f]{4}|000[1-9A-Fa-f][0-9A-Fa-f]{4}|0010[0-9A-Fa-f]{4})"
_ESCAPES = (
    r"\\[tbnrf\"'\\]|\\u(?![Dd][89A-Fa-f])[0-9A-Fa-f]{4}"
    rf"|\\u[Dd][89ABab][0-9A-Fa-f]{{2}}\\u[Dd][C-Fc-f][0-9A-Fa-f]{{2}}|{_LONG}"
)


def _unescape(c: Column) -> Column:
    """Undo the backslash escapes: those of JSON strings, ``\\'`` and code points in eight digits."""

    def piece(x: Column) -> Column:
        point = F.decode(F.unhex(F.substr(x, F.lit(3))), "UTF-32")
        short = F.concat(F.lit("\\u"), F.substr(x, F.lit(7)))
        return F.when(F.startswith(x, F.lit("\\U0000")), short).when(F.startswith(x, F.lit("\\U")), point).when(x == "\\'", F.lit("'")).otherwise(x)

    pieces = F.regexp_extract_all(c, F.lit(rf"(?s){_LONG}|\\.|[^\\]+"), F.lit(0))
    own = F.contains(c, F.lit("\\U")) | F.contains(c, F.lit("\\'"))
    plain = F.when(own, F.array_join(F.transform(pieces, piece), "")).otherwise(c)
    listed = F.concat(F.lit('["'), plain, F.lit('"]'))
    decoded = F.get(F.from_json(listed, "array<string>", {"allowUnquotedControlChars": "true"}), F.lit(0))
    return F.when(F.contains(c, F.lit("\\")), decoded).otherwise(c)


def _parts(df: DataFrame, line_col: str) -> DataFrame:
    """``line`` and its five ``fields``, which are null where it is no statement."""
    backslash = F.contains("line", F.lit("\\"))
    hidden = F.replace(F.replace("line", F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))

    def show(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(QUOTE), F.lit('\\"')), F.lit(BACKSLASH), F.lit("\\\\"))

    cut = _once(df.select(F.col(line_col).alias("line")), F.split(F.regexp_replace(hidden, _STATEMENT, _FIELDS), _SEPARATOR, 5), "cut")
    shown = _once(cut, F.when(backslash, F.transform("cut", show)).otherwise(F.col("cut")), "shown")
    # Without its escapes a part holds no backslash.
    faulty = F.exists("shown", lambda x: F.contains(F.regexp_replace(x, _ESCAPES, ""), F.lit("\\")))
    marked = F.contains("line", F.lit(BACKSLASH)) | F.contains("line", F.lit(QUOTE))
    whole = (F.size("cut") == 5) & ~marked & ~(backslash & faulty)
    return _once(shown, F.when(whole, F.col("shown")), "fields").select("line", "fields")


def _once(df: DataFrame, c: Column, name: str) -> DataFrame:
    """``df`` with a column that is computed once a row; a plain one is computed again in every filter and use above it."""
    return df.select("*", F.explode(F.array(c)).alias(name))


def parse_ntriples(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Statement lines to ``(s, p, o, o_kind, o_datatype)``; comments and blanks are skipped.

    A blank node is named by its label with ``_:`` and counts as an IRI. Language tags are dropped.
    Lines that are no statement are those of :func:`rejected_ntriples`.
    """
    statements = _parts(df, line_col).where(F.col("fields").isNotNull())

    def part(i: int) -> Column:
        return F.get(F.col("fields"), F.lit(i))

    def node(c: Column) -> Column:
        return F.when(F.startswith(c, F.lit("<")), _unescape(F.substr(c, F.lit(2), F.length(c) - 2))).otherwise(c)

    literal = part(2) == ""
    return statements.select(
        node(part(0)).alias("s"),
        _unescape(part(1)).alias("p"),
        F.when(literal, _unescape(part(4))).otherwise(node(part(2))).alias("o"),
        F.when(literal, F.lit("literal")).otherwise(F.lit("iri")).alias("o_kind"),
        F.when(part(3) != "", _unescape(part(3))).alias("o_datatype"),
    )


def rejected_ntriples(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines that are neither statements nor comments nor blank, in ``line``."""
    return _parts(df, line_col).where(F.col("fields").isNull() & ~F.col("line").rlike(r"^\s*(?:#|$)")).select("line")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Scan N-Triples files; lines are split among tasks like any text."""
    return parse_ntriples(_lines(spark, path))


def read_rejected_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """The lines that :func:`read_ntriples` cannot read."""
    return rejected_ntriples(_lines(spark, path))
