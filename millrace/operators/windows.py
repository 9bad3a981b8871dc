"""Ranked and running operators for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.storage import materialize

# Rows that a task sorts, on average: what it holds does not grow with the table.
_TASK_ROWS = 1 << 18


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as its number of ``rows`` asks for.

    The session's number of partitions is fixed, so that theirs would grow.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-rows // _TASK_ROWS)), *keys)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group.

    Catalyst puts a group limit in front of the shuffle, so a hot group sends
    ``n`` rows per task and not all of its rows.  ``order`` should end in a
    unique column, otherwise ties are cut arbitrarily.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """``name`` = sum of ``value`` over the group's rows up to and with this one.

    A plain window would sort each whole group in one task.  Here the rows are
    range-partitioned on keys and order, so a hot group spreads over many
    chunks; a chunk's starting value comes from the totals of the chunks before
    it, and only the rows inside a chunk are summed in sequence.  The
    partitioned rows are written once, since the chunk numbers must be the same
    for the totals and for the rows.
    """
    layout = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    spread = (
        df.repartitionByRange(partitions, *layout)
        if partitions
        else df.repartitionByRange(*layout)
    )
    rows = materialize(spread.withColumn("_chunk", F.spark_partition_id()), "running")

    # One row per group and chunk: what the earlier chunks of the group add up to.
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_value"))
    earlier = (
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = totals.withColumn("_value", F.sum("_value").over(earlier)).filter(
        F.col("_value").isNotNull()
    )
    # The starting value goes in front of the chunk's rows as a row of its own,
    # so one window adds it up and no join is needed.
    kind = totals.schema["_value"].dataType
    marked = rows.withColumn("_value", F.col(value).cast(kind)).withColumn("_row", F.lit(1))
    both = marked.unionByName(
        starts.withColumn("_value", F.col("_value").cast(kind)).withColumn("_row", F.lit(0)),
        allowMissingColumns=True,
    )
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy("_row", *[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.coalesce(F.sum("_value").over(inside).cast(kind), F.lit(0).cast(kind))
    return both.withColumn(name, total).filter("_row = 1").select(*df.columns, name)


def running_by_period(
    df: DataFrame, keys: Sequence[str], period: str, value: str, name: str
) -> DataFrame:
    """Running sum over calendar periods.

    For input with at most one row per key and period: the group length is
    bounded by the calendar, not by the data, so a plain window is right.
    """
    w = (
        Window.partitionBy(*keys)
        .orderBy(period)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.sum(value).over(w))
