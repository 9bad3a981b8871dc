"""Repeatable samples that do not depend on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.storage import materialize

# Leading hex digits of the hash used as a number: 7 digits fit an int.
_DIGITS = 7


def hash_order(key: Column | str, seed: int) -> Column:
    """Pseudo-random text order of the rows, fixed by key and seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _leading(hashed: Column, digits: int = _DIGITS) -> Column:
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def bernoulli_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Keep each row with probability ``fraction``, decided by its key."""
    return df.filter(_leading(hash_order(key, seed)) < int(fraction * 16**_DIGITS))


def sample_per_class(
    df: DataFrame, classes: Sequence[str], key: str, n: int, seed: int
) -> DataFrame:
    """Exactly ``n`` rows per class, or the whole class if it is smaller.

    The hash space is cut into equal slices.  Counting rows per slice tells in
    which slice the n-th row of a class lies; rows of earlier slices are all
    taken and only that slice is ranked.  No class is sorted as a whole.
    """
    hashed = df.withColumn("_hash", hash_order(key, seed))
    hashed = hashed.withColumn("_slice", _leading(F.col("_hash"), 4))
    counts = hashed.groupBy(*classes, "_slice").agg(F.count("*").alias("_rows"))
    upto = (
        Window.partitionBy(*classes)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = counts.withColumn("_seen", F.sum("_rows").over(upto))
    cut = (
        filled.filter(F.col("_seen") >= n)
        .groupBy(*[F.col(c).alias(f"_{c}") for c in classes])
        .agg(
            F.min("_slice").alias("_cut"),
            (n - F.min(F.col("_seen")) + F.min_by("_rows", "_slice")).alias("_need"),
        )
    )
    # One row per class.  As a written table its size is known, so Catalyst
    # broadcasts it when it is small and shuffles when there are many classes.
    cut = materialize(cut, "sample-cut")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in classes]
    placed = hashed.join(cut, same, "left")
    below = placed.filter(F.col("_cut").isNull() | (F.col("_slice") < F.col("_cut")))
    edge = placed.filter(F.col("_slice") == F.col("_cut"))
    order = Window.partitionBy(*classes).orderBy("_hash", key)
    edge = (
        edge.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= n)
        .filter(F.col("_rank") <= F.col("_need"))
    )
    return below.select(*df.columns).unionByName(edge.select(*df.columns))
