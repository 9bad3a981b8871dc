"""Differences of two large tables, found through a tree of checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import materialize

# Buckets of the first level, and leaves of each of them.
TOPS, LEAVES = 4_096, 1_024
_LOW = 0xFFFFFFFF


def _leaf(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit("leaf"), *keys), F.lit(TOPS * LEAVES))


def _checksums(rows: DataFrame, columns: Sequence[str], by: Column) -> DataFrame:
    """Per bucket the rows and the sums of 128 hash bits, ``sign`` times.

    Sums and not exclusive ors: two equal rows do not cancel out.  The hash is
    added in halves of 32 bits, so 2**31 rows of a bucket fit in a long.
    """
    parts = {"rows": F.col("sign")}
    for seed in ("a", "b"):
        h = F.xxhash64(F.lit(seed), *columns)
        parts[f"{seed}_low"] = F.col("sign") * h.bitwiseAND(F.lit(_LOW))
        parts[f"{seed}_high"] = F.col("sign") * F.shiftrightunsigned(h, 32)
    return rows.groupBy(by.alias("bucket")).agg(*[F.sum(c).alias(n) for n, c in parts.items()])


def _differing(checksums: DataFrame) -> DataFrame:
    names = [c for c in checksums.columns if c != "bucket"]
    return checksums.filter(" OR ".join(f"{n} <> 0" for n in names)).select("bucket")


def differing_leaves(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``bucket``: the leaves whose checksums differ, of rows with a ``sign``.

    The first level shuffles at most ``TOPS`` rows per task; the second reads
    the rows again and shuffles checksums of leaves below differing buckets only.
    """
    columns = [*keys, *values]
    top = F.floor(_leaf(keys) / LEAVES)
    # At most TOPS rows of one number.
    tops = materialize(_differing(_checksums(rows, columns, top)), "reconcile-tops")
    some = rows.join(
        F.broadcast(tops.withColumnRenamed("bucket", "_top")), top == F.col("_top"), "left_semi"
    )
    return materialize(_differing(_checksums(some, columns, _leaf(keys))), "reconcile-leaves")


def differences(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """``keys, expected, actual, reason``: what two tables do not agree on.

    ``expected`` and ``actual`` are structs of the values; ``reason`` is
    ``differs`` or, where one side has no such row, ``missing``.  Nulls are
    values like others, in keys too.  A key with several rows is compared as a
    bag: of the rows that one side has more often the smallest is shown.

    Two levels of checksums by a hash of the key tell where the tables differ;
    only rows of differing leaves are shuffled, so equal tables of any size
    exchange checksums alone.  A hot key is one row per task and value before
    the shuffle.  Equal checksums of different rows (128 bits) are taken as equal.
    """
    columns = [*keys, *values]
    rows = (
        expected.select(*columns)
        .withColumn("sign", F.lit(1).cast("bigint"))
        .unionByName(actual.select(*columns).withColumn("sign", F.lit(-1).cast("bigint")))
    )
    leaves = differing_leaves(rows, keys, values).withColumnRenamed("bucket", "_leaf")
    suspect = rows.join(leaves, _leaf(keys) == F.col("_leaf"), "left_semi")
    surplus = suspect.groupBy(*columns).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    row = F.struct(*values)
    sides = surplus.groupBy(*keys).agg(
        F.min(F.when(F.col("sign") > 0, row)).alias("expected"),
        F.min(F.when(F.col("sign") < 0, row)).alias("actual"),
    )
    both = F.col("expected").isNotNull() & F.col("actual").isNotNull()
    return sides.withColumn("reason", F.when(both, "differs").otherwise("missing"))
