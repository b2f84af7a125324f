"""Sharding along a Hilbert curve, in DataFrame operations only.

Several dimensions of the metadata are quantised to a few bits each: text columns by the rank of
the value among all values, numbers by equal widths between the least and the greatest, the size
by its binary length. The cell of a row has an index on the Hilbert curve through all cells, whose
neighbours differ in one dimension by one. Rows are sorted by that index over the whole table and
the sorted run is cut into shards, so that each shard covers a narrow range of every dimension and
readers can leave out files by the least and greatest values of several columns.

Cuts are by position, never by key, so a value that a third of all rows share fills a third of the shards. The sort sees
ids, sizes and checksums only; texts are read once, unless they are to be written.

Laws: ``rows`` (the numbers of rows of any two shards differ by one at most) and ``bytes`` (a shard
ends where its share of all bytes is reached, so sizes are near equal up to one row).

Defined cases: a null text has no bytes, size 1 and checksum 0; nulls of a dimension lie in its first
step; equal cells are ordered by id (null first), checksum and size; rows that repeat all of
these are interchangeable and keep places of their own; equal texts may lie in different shards;
fewer rows than shards leave shards empty; empty tables give empty tables; other columns of
the table do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from epilink.llm.ranks import marked, ranked

SHARDS = 16
#: Bits of each dimension.
BITS = 5
#: Metadata columns that are dimensions, besides the size.
DIMENSIONS = ("source", "lang", "doc_id")


def curve_index(df: DataFrame, axes: list[str], bits: int, out: str = "curve") -> DataFrame:
    """``df`` with the index ``out`` of the cell at the integer columns ``axes`` (0 to 2^bits - 1 each), without the axes.

    After J. Skilling, "Programming the Hilbert curve" (2004): undo the rotations from the highest
    bit down, take the Gray code, and read the bits of all axes in turn.
    """
    first = F.col(axes[0])
    for q in range(bits - 1, 0, -1):
        low = F.lit((1 << q) - 1)
        for axis in axes:
            x = F.col(axis)
            high = F.getbit(x, F.lit(q)) == 1
            if axis == axes[0]:
                df = df.withColumn(axis, F.when(high, x.bitwiseXOR(low)).otherwise(x))
            else:
                swap = first.bitwiseXOR(x).bitwiseAND(low)
                df = df.withColumns(
                    {
                        axes[0]: F.when(high, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap)),
                        axis: F.when(high, x).otherwise(x.bitwiseXOR(swap)),
                    }
                )
    for before, axis in zip(axes, axes[1:]):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    turn = F.lit(0)
    for q in range(1, bits):
        turn = turn.bitwiseXOR(F.when(F.getbit(F.col(axes[-1]), F.lit(q)) == 1, F.lit((1 << q) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_turn", turn)
    index = F.lit(0).cast("long")
    for q in range(bits - 1, -1, -1):
        for axis in axes:
            index = F.shiftleft(index, 1).bitwiseOR(F.getbit(F.col(axis).bitwiseXOR(F.col("_turn")), F.lit(q)).cast("long"))
    return df.withColumn(out, index).drop("_turn", *axes)


def _text_edges(docs: DataFrame, columns: list[str], steps: int) -> dict[str, list[str]]:
    """For each text column the values at which a step begins, of ``steps`` steps with as many distinct values each.

    All distinct values are ranked by Spark; at most ``steps`` of each column come to the driver.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("axis"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    values = docs.select(F.inline(pairs)).filter("value is not null").distinct()
    placed = ranked(values, ["axis", "value"], "values")
    spans = placed.groupBy("axis").agg(F.min("_place").alias("_least"), F.count("*").alias("_values"))
    step = lambda place: F.floor(place * steps / F.col("_values"))
    rank = F.col("_place") - F.col("_least")
    begins = placed.join(F.broadcast(spans), "axis").filter((rank > 0) & (step(rank) > step(rank - 1)))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for axis, value, at in begins.select("axis", "value", step(rank).alias("at")).collect():
        found[columns[axis]].append((at, value))
    return {c: sorted(v) for c, v in found.items()}


def _quantised(docs: DataFrame, dimensions: tuple[str, ...], size: Column, bits: int) -> list[Column]:
    steps = 1 << bits
    is_text = {f.name: isinstance(f.dataType, StringType) for f in docs.schema.fields}
    edges = _text_edges(docs, [c for c in dimensions if is_text[c]], steps)
    numbers = [c for c in dimensions if not is_text[c]]
    ends = docs.agg(*[f(F.col(c).cast("double")) for c in numbers for f in (F.min, F.max)]).first() if numbers else ()
    out = []
    for c in dimensions:
        if is_text[c]:
            step = F.lit(0)
            for at, value in edges[c]:
                step = F.when(F.col(c) >= F.lit(value), F.lit(at).cast("int")).otherwise(step)
        else:
            least, most = ends[2 * numbers.index(c)], ends[2 * numbers.index(c) + 1]
            width = (most or 0.0) - (least or 0.0) + 1.0
            step = F.floor((F.col(c).cast("double") - F.lit(least)) / F.lit(width) * steps).cast("int")
        out.append(F.coalesce(F.least(step, F.lit(steps - 1)), F.lit(0)))
    out.append(F.least(F.length(F.bin(size)) - 1, F.lit(steps - 1)))
    return out


def place(
    docs: DataFrame,
    shards: int = SHARDS,
    law: str = "rows",
    dimensions: tuple[str, ...] = DIMENSIONS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, curve, law, shard, slot``.

    ``slot`` counts the rows of a shard from 0, in the order of the curve. ``whole`` adds the row itself
    as the struct ``doc``, which then goes through the sort.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law must be rows or bytes, not {law!r}")
    if bits * (len(dimensions) + 1) > 62:
        raise ValueError("the bits of all dimensions must fit a long")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    steps = _quantised(docs, dimensions, size, bits)
    axes = [f"_x{i}" for i in range(len(steps))]
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if whole else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(text_col, F.lit("")).cast("binary")).alias("text_crc32"),
        *[s.alias(a) for s, a in zip(steps, axes)],
        *kept,
    )
    rows = marked(curve_index(rows, axes, bits), "curve")
    placed = ranked(rows, ["curve", "doc_id", "text_crc32", "size", "_row"], "sorted")
    if law == "rows":
        n = rows.count()
        placed = placed.withColumn("shard", F.floor(F.col("_place") * shards / F.lit(max(n, 1))).cast("int"))
    else:
        own = Window.partitionBy("_task").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        tasks = placed.groupBy("_task").agg(F.sum("size").alias("_bytes"))
        begins = tasks.select("_task", (F.sum("_bytes").over(Window.orderBy("_task")) - F.col("_bytes")).alias("_begin"))
        total = rows.agg(F.sum("size")).first()[0] or 1
        # A row lies where its middle lies.
        middle = F.col("_begin") + F.sum("size").over(own) - F.col("size") / 2
        placed = placed.join(F.broadcast(begins), "_task").withColumn("shard", F.least(F.floor(middle * shards / F.lit(total)), F.lit(shards - 1)).cast("int"))
    # One row for each shard.
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    placed = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("_place") - F.col("_first"))
    return placed.select("doc_id", "size", "text_crc32", "curve", F.lit(law).alias("law"), "shard", "slot", *(["doc"] if whole else []))


def ranges(placed: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Least and greatest value of each dimension in each shard of ``placed`` (made with ``whole``): what a reader prunes by."""
    ends = [f(F.col(f"doc.{c}")).alias(f"{name}_{c}") for c in dimensions for name, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends)


def write_shards(docs: DataFrame, path: str, **options) -> str:
    """``docs`` written as Parquet in one folder ``shard=n`` for each shard; a file holds a run of the curve."""
    placed = place(docs, whole=True, **options)
    columns = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    placed.select(*columns, "slot", "shard").write.partitionBy("shard").parquet(path)
    return path


def digest(placed: DataFrame) -> DataFrame:
    """The columns of the query from those of :func:`place`."""
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
