"""Row changes as new snapshots of a table.

Parquet tables take no UPDATE or DELETE, and a table cannot be overwritten
while it is read; each function returns the changed table for the caller to
write next to the old one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column name; columns they lack become null."""
    extra = set(rows.columns) - set(table.columns)
    if extra:
        raise ValueError(f"columns not in the table: {sorted(extra)}")
    typed = rows.select(*[F.col(c).cast(table.schema[c].dataType) for c in rows.columns])
    return table.unionByName(typed, allowMissingColumns=True)


def update_rows(table: DataFrame, where: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Change the rows for which ``where`` is true; unknown counts as false."""
    hit = F.coalesce(where, F.lit(False))
    return table.withColumns(
        {
            c: F.when(hit, new.cast(table.schema[c].dataType)).otherwise(F.col(c))
            for c, new in changes.items()
        }
    )


def delete_rows(table: DataFrame, where: Column) -> DataFrame:
    """Drop the rows for which ``where`` is true; unknown keeps the row."""
    return table.filter(~F.coalesce(where, F.lit(False)))


def upsert_rows(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Replace rows whose key is in ``changes`` and append the new keys.

    A column missing from ``changes`` keeps its old value, a changed value may
    be null.  Of several changes of one key the greatest counts, compared by
    the other columns in their order.
    """
    rest = [c for c in changes.columns if c != key]
    newest = F.max(F.struct(*rest)) if rest else F.lit(None)
    changes = (
        changes.groupBy(key)
        .agg(newest.alias("_last"))
        .select(*[F.col(key) if c == key else F.col(f"_last.{c}") for c in changes.columns])
    )
    side = changes.select(*[F.col(c).alias(f"_new_{c}") for c in changes.columns])
    # Two joins instead of a full one: AQE can split a hot key of the table.
    old = table.join(side, F.col(key) == F.col(f"_new_{key}"), "left")
    changed = F.col(f"_new_{key}").isNotNull()
    updated = old.select(
        *[
            F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in changes.columns
            else F.col(c)
            for c in table.columns
        ]
    )
    known = table.select(F.col(key).alias("_known")).distinct()
    new = changes.join(known, F.col(key) == F.col("_known"), "left_anti")
    return insert_rows(updated, new)


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: the check a primary key would make."""
    return table.groupBy(*keys).count().filter("count > 1")


def latest_snapshot(snapshots: DataFrame, key: str, taken: str) -> DataFrame:
    """Newest row per key among archived snapshots.

    The newest row is found by a partial aggregate on (date, row), so many
    snapshots of one key never meet in one sort.
    """
    rest = [c for c in snapshots.columns if c not in (key, taken)]
    newest = F.max(F.struct(F.col(taken), *[F.col(c) for c in rest])).alias("_row")
    return (
        snapshots.groupBy(key)
        .agg(newest)
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in snapshots.columns if c != key])
    )
