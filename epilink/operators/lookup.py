"""Left joins against a side with one row per key, broadcast only when measured small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from ..session import settle

# A measured side up to this size is sent to every executor; beyond it both sides are
# shuffled on the key and adaptive execution splits keys that hold too many rows.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size, counted over all rows: 16 bytes a row, 8 a field, plus text."""
    per_row = F.lit(16 + 8 * len(df.columns)).cast("long")
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(c), F.lit(0))
        elif field.dataType.simpleString().startswith(("array", "struct", "map")):
            per_row = per_row + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return df.agg(F.sum(per_row)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df``, marked for broadcast if it measures at most ``limit_bytes``, else for a join by shuffling.

    It is measured and used, so give it a stored or settled table.
    """
    return marked(df, measured_bytes(df) <= limit_bytes)


def marked(df: DataFrame, small: bool) -> DataFrame:
    """``df`` as a join side that is broadcast if ``small`` and never otherwise.

    Spark's own estimate follows the size of the files, whatever was made of their rows since.
    """
    return F.broadcast(df) if small else df.hint("merge")


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    compute_once: bool = True,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """``left`` with the columns of ``right``, which has at most one row per key.

    ``compute_once`` settles a derived right side before it is measured, so that
    measuring and joining do not both pay for it; leave it off for a stored table.
    """
    right = right.dropna(subset=list(on))
    if compute_once:
        right = settle(right)
    return left.join(broadcast_if_small(right, limit_bytes), list(on), "left")
