"""Exact positions and running totals that never put a hot group into one task.

Spark's window functions pull a whole partition key into one task. These helpers
split every group into chunks of its integer position, solve each chunk on its
own, and add what came before from a table of chunk totals.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.plans.staging import stage

CHUNK = 1 << 17


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    out: str,
    *,
    chunk: int = CHUNK,
    tie: Sequence[str] = (),
    inclusive: bool = True,
) -> DataFrame:
    """Running sum of ``value`` per ``keys`` in the order of ``position`` then ``tie``.

    A chunk holds the rows of one key whose position falls into one span of ``chunk``
    values; the offset table has one row per (key, chunk).
    """
    keyed = df.withColumn("_rt_chunk", F.floor(F.col(position) / chunk)).withColumn("_rt_value", value)
    order = [position, *tie]
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    local = Window.partitionBy(*keys, "_rt_chunk").orderBy(*order).rowsBetween(*frame)
    totals = keyed.groupBy(*keys, "_rt_chunk").agg(F.sum("_rt_value").alias("_rt_total"))
    before = Window.partitionBy(*keys).orderBy("_rt_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_rt_k{i}") for i, k in enumerate(keys)],
        F.col("_rt_chunk").alias("_rt_c"),
        F.coalesce(F.sum("_rt_total").over(before), F.lit(0)).alias("_rt_before"),
    )
    on = F.col("_rt_chunk").eqNullSafe(F.col("_rt_c"))
    for i, key in enumerate(keys):
        on = on & F.col(key).eqNullSafe(F.col(f"_rt_k{i}"))
    return (
        keyed.withColumn("_rt_local", F.coalesce(F.sum("_rt_value").over(local), F.lit(0)))
        .join(offsets, on)
        .withColumn(out, F.col("_rt_before") + F.col("_rt_local"))
        .select(*df.columns, out)
    )


def ordinal(df: DataFrame, keys: Sequence[str], position: str, out: str, *, chunk: int = CHUNK) -> DataFrame:
    """1-based rank of each row inside ``keys``; ``position`` must be unique inside them."""
    return running_total(df, keys, position, F.lit(1), out, chunk=chunk)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    columns: dict[str, str],
) -> DataFrame:
    """Add the value each column had in the row before, per ``keys``; like ``lag``.

    ``chunk`` must not decrease along ``order``; it splits a long series into
    pieces, and the last row of each piece is handed to the next one.
    """
    keyed = df.withColumn("_chunk", chunk)
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    tails = keyed.groupBy(*keys, "_chunk").agg(
        F.max_by(F.struct(*columns), F.struct(*order)).alias("_tail")
    )
    across = Window.partitionBy(*keys).orderBy("_chunk")
    handed = tails.select(*keys, "_chunk", F.lag("_tail").over(across).alias("_handed"))
    local = keyed.withColumn("_first", F.row_number().over(within) == 1)
    for source, out in columns.items():
        local = local.withColumn(out, F.lag(source).over(within))
    joined = local.join(handed, [*keys, "_chunk"], "left")
    for source, out in columns.items():
        joined = joined.withColumn(
            out, F.when(F.col("_first"), F.col("_handed").getField(source)).otherwise(F.col(out))
        )
    return joined.select(*df.columns, *columns.values())


def global_index(
    df: DataFrame,
    order: Sequence[str],
    out: str,
    *,
    label: str = "ordered",
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """0-based dense index over the whole table in the order of ``order``.

    One range shuffle; the ranges are staged so that the partition numbers they
    got stay fixed. The offset table has one row per partition, so it is small
    by construction and safe to broadcast. ``shape`` maps row by row behind the shuffle:
    work done before it is done twice, as the ranges are sampled.
    """
    local_mask = (1 << 33) - 1
    df = shape(df.repartitionByRange(*order).sortWithinPartitions(*order))
    ranged = df.withColumn("_mono", F.monotonically_increasing_id())
    staged = stage(ranged, label).withColumn("_part", F.shiftright("_mono", 33))
    counts = staged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_gi_before"))
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_gi_before") + F.col("_mono").bitwiseAND(local_mask))
        .select(*df.columns, out)
    )


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, *, label: str = "grouped"
) -> DataFrame:
    """0-based position inside ``keys`` in the order of ``order``, for any order columns."""
    indexed = global_index(df, [*keys, *order], "_index", label=label)
    starts = indexed.groupBy(*keys).agg(F.min("_index").alias("_start"))
    return (
        indexed.join(starts, list(keys))
        .withColumn(out, F.col("_index") - F.col("_start"))
        .select(*df.columns, out)
    )
