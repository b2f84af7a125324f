"""Places of rows in an order over the whole table, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epilink.llm.tables import stored

#: Bits of ``monotonically_increasing_id`` that count the rows of one task.
_ROW_BITS = 33


def ranked(rows: DataFrame, order: list, label: str) -> DataFrame:
    """``rows``, stored in ``order``, with ``_place``: 0 for the first row, without gaps.

    One sort by range. A task numbers its own rows; the numbers of rows of all tasks, one row for
    each task, give where it begins. ``order`` should tell all rows apart (:func:`marked`), so that
    the sort can split a key that many rows share.
    """
    at = F.monotonically_increasing_id()
    laid = rows.orderBy(*order).withColumn("_at", at)
    laid = laid.select("*", F.shiftrightunsigned("_at", _ROW_BITS).alias("_task"), F.expr(f"_at & {(1 << _ROW_BITS) - 1}L").alias("_in_task"))
    laid = stored(laid.drop("_at"), label)
    tasks = laid.groupBy("_task").agg(F.count("*").alias("_task_rows"))
    begins = tasks.select("_task", (F.sum("_task_rows").over(Window.orderBy("_task")) - F.col("_task_rows")).alias("_task_begin"))
    placed = laid.join(F.broadcast(begins), "_task")
    return placed.withColumn("_place", F.col("_task_begin") + F.col("_in_task")).drop("_task_begin", "_in_task")


def marked(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` stored with ``_row``, a number that is different in every row and fixed by the storing."""
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), label)
