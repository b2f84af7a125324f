"""Exact duplicates of whole texts, in DataFrame operations only.

Texts are equal when they are the same bytes after each run of ASCII white space
(``[\\x20\\x09-\\x0D]+``) became one blank. Rows are grouped by a 128-bit hash of that form and,
within the hash, by the bytes themselves, so two texts that collide stay two groups. The groups
are counted in each task before the shuffle; a text that makes up a third of all rows is one row
per task.

Defined cases: a null text counts as empty, and empty texts equal each other; the smallest id
stays, null ids only where a group has no other; a row that repeats both id and text is kept
once and its repetitions are not; empty tables give empty tables; very long texts are whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilink.llm.tables import row_key, whole


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("_text"))
    # Number of rows and smallest id of each text: by hash, and by bytes within the hash.
    groups = (
        rows.groupBy(F.md5("_text").alias("_md5"), "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("_md5", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    # Both hashes name a group. Repeated rows are one row with a count up to here.
    slim = rows.select("doc_id", F.md5("_text").alias("_md5"), F.sha2("_text", 256).alias("text_sha256"))
    slim = slim.groupBy("doc_id", "_md5", "text_sha256").agg(F.count("*").alias("_n"))
    return (
        slim.join(groups, ["_md5", "text_sha256"])
        .select("doc_id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i"))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"), "text_sha256")
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(row_key("doc_id", "text_sha256").alias("_row"))
    rows = docs.select(whole(docs), F.col(id_col).alias("_id"), F.sha2(normalised(F.col(text_col)), 256).alias("_sha"))
    rows = rows.select("_doc", row_key("_id", "_sha").alias("_row"))
    return rows.join(kept, "_row", "left_semi").dropDuplicates(["_row"]).select("_doc.*")
