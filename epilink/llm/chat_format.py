"""Chat formatting with a grammar round trip, in DataFrame operations only.

A turn is written as ``<turn role>``, a line end, its text, a line end, ``</turn>`` and a line end;
a conversation is its turns one after another. Each turn is written plainly first and read back by
the parser. If what comes back is not the role and text that went in, because they hold marks of
the grammar or backslashes, the turn is written again with a backslash after each ``<`` that would
begin a mark, and before each backslash and, in roles, each ``>`` and line end. The escaped form always
comes back as it was; a turn that did not would end the job with an error.

The loss mask covers the texts of the assistant, between the line ends.

Defined cases: a null text or role counts as empty; turns are ordered by number, null first, and
by role and text where the numbers are equal; repeated rows are turns of their own; rows with a
null conversation id are one conversation; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLOSE = "\n</turn>\n"
_MARK = r"<(?=/?turn)"


def _escape(text):
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _MARK, "<\\\\")


def _escape_role(role):
    return F.regexp_replace(_escape(role), r"(?s)([>\n])", "\\\\$1")


def unescape(text):
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _rendered(role, text):
    return F.concat(F.lit("<turn "), role, F.lit(">\n"), text, F.lit(CLOSE))


#: The role of a turn ends at the first ``>`` with a line end that no backslash stands before. Possessive, as Java
#: matches any other repeated group by recursion, which long roles overflow; a role has one reading only.
_HEAD = r"(?s)^<turn ((?:[^\\>]++|\\.)*+)>\n"


def parse(formatted):
    """Turns of formatted text: ``array<struct<role, body, head>>`` with the body as it is written and the length of its head."""
    pieces = F.split(formatted, CLOSE)
    return F.transform(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape(F.regexp_extract(p, _HEAD, 1)).alias("role"),
            F.regexp_replace(p, _HEAD, "").alias("body"),
            F.length(F.regexp_extract(p, _HEAD, 0)).alias("head"),
        ),
    )


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, n_escaped``."""
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )

    def back(written):
        read = parse(written)
        return (F.size(read) == 1) & (F.try_element_at(read, F.lit(1))["role"] == F.col("role")) & (unescape(F.try_element_at(read, F.lit(1))["body"]) == F.col("text"))

    plain, safe = _rendered(F.col("role"), F.col("text")), _rendered(_escape_role(F.col("role")), _escape(F.col("text")))
    rows = rows.withColumn("same", F.coalesce(back(plain), F.lit(False)))
    checked = F.when(F.coalesce(back(safe), F.lit(False)), safe).otherwise(F.raise_error(F.lit("a turn did not come back from its formatted text")).cast("string"))
    rows = rows.withColumn("written", F.when(F.col("same"), plain).otherwise(checked))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "written"))), lambda t: t["written"]), "").alias("formatted"),
        F.sum(F.when(F.col("same"), 0).otherwise(1)).alias("n_escaped"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role and text) and ``loss`` (start, end and written text of each part under the loss mask) from ``formatted``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<role:string,text:string>>").alias("turns"), F.array().cast("array<struct<start:int,end:int,body:string>>").alias("loss"))

    def step(state, t):
        begin = state["at"] + t["head"]
        end = begin + F.length(t["body"])
        masked = F.array(F.struct(begin.alias("start"), end.alias("end"), t["body"].alias("body")))
        return F.struct(
            (end + len(CLOSE)).alias("at"),
            F.concat(state["turns"], F.array(F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")))).alias("turns"),
            F.when(t["role"] == "assistant", F.concat(state["loss"], masked)).otherwise(state["loss"]).alias("loss"),
        )

    read = formatted.withColumn("_read", F.aggregate(parse(F.col("formatted")), start, step))
    return read.select(*formatted.columns, "_read.turns", "_read.loss")


def digest(read: DataFrame) -> DataFrame:
    """The columns of the query from those of :func:`read_back`."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss", lambda s: unescape(s["body"])), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
