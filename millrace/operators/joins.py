"""Joins with the semantics the analyses rely on.

Dimension tables get no broadcast hint: Catalyst compares the size of the scan
with ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where AQE
splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, take: Mapping[str, str]
) -> DataFrame:
    """Left join that adds dimension columns under new names.

    Calling it twice with the same dimension plays it in two roles.
    """
    side = dim.select(
        F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(new) for c, new in take.items()]
    )
    return fact.join(side, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")


def outer_to_many(
    one: DataFrame, many: DataFrame, one_key: str, many_key: str, keep_many: bool = False
) -> DataFrame:
    """``one LEFT JOIN many`` (or FULL JOIN) where a key may be hot in ``many``.

    AQE can split a hot key only on the preserved side of an outer join.  So
    the rows of ``many`` look up their partner, which can be split, and the rows
    of ``one`` that nobody referred to are added from an anti join against the
    distinct keys.
    """
    key = many.select(F.col(many_key).alias("_key")).distinct()
    matched = many.join(
        one, F.col(many_key) == F.col(one_key), "left" if keep_many else "inner"
    )
    alone = one.join(key, F.col(one_key) == F.col("_key"), "left_anti")
    columns = [*one.columns, *many.columns]
    return matched.select(*columns).unionByName(alone, allowMissingColumns=True)


def count_by_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    label: str,
    counted: str,
    name: str,
    how: str = "left",
) -> DataFrame:
    """Count fact rows per dimension label.

    Facts are counted per key first, so a hot key reaches the join as one row.
    """
    per_key = fact.groupBy(fact_key).agg(F.count(counted).alias("_n"))
    side = dim.select(F.col(dim_key).alias("_dim_key"), label)
    return (
        per_key.join(side, F.col(fact_key) == F.col("_dim_key"), how)
        .groupBy(label)
        .agg(F.sum("_n").alias(name))
    )


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    key: str,
    expected_value: str,
    actual_value: str,
    same: Column | None = None,
) -> DataFrame:
    """Compare two tables key by key.

    PASS where the values agree, FAIL where they differ, and FAIL with reason
    'missing' where one side has no such key.
    """
    left = expected.select(F.col(key).alias("_l"), F.col(expected_value).alias("expected"))
    right = actual.select(F.col(key).alias("_r"), F.col(actual_value).alias("actual"))
    agree = F.col("expected").eqNullSafe(F.col("actual")) if same is None else same
    joined = left.join(right, F.col("_l") == F.col("_r"), "full")
    found = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return joined.select(
        F.coalesce("_l", "_r").alias(key),
        "expected",
        "actual",
        F.when(found & agree, "PASS").otherwise("FAIL").alias("status"),
        F.when(~found, "missing").when(~agree, "differs").alias("reason"),
    )


def partner_counts(df: DataFrame, group: str, key: str, name: str = "partners") -> DataFrame:
    """For each row, how many other rows share its group.

    This is the self join ``a.group = b.group AND a.key <> b.key`` counted per
    row.  It grows with the rows; the list of all pairs grows with the square
    of the largest group.  Rows without a partner are left out, as in the join.
    """
    sizes = df.groupBy(F.col(group).alias("_group")).agg((F.count(key) - 1).alias(name))
    return (
        df.join(sizes.filter(F.col(name) > 0), F.col(group) == F.col("_group"))
        .drop("_group")
    )


def pairs_with(
    probe: DataFrame, table: DataFrame, group: str, key: str, columns: Sequence[str]
) -> DataFrame:
    """Every other row of the group for each row of ``probe``.

    Equality on the group plus inequality on the key; the left columns are
    prefixed ``a_`` and the right ones ``b_``.  The result has one row per
    probe row and group member, so keep at most a few probes per group.
    """
    a = probe.select(F.col(group), *[F.col(c).alias(f"a_{c}") for c in [key, *columns]])
    b = table.select(
        F.col(group).alias("_group"), *[F.col(c).alias(f"b_{c}") for c in [key, *columns]]
    )
    on = (F.col(group) == F.col("_group")) & (F.col(f"a_{key}") != F.col(f"b_{key}"))
    return a.join(b, on).drop("_group")


def membership_flags(
    entities: DataFrame,
    bridge: DataFrame,
    entity_key: str,
    bridge_key: str,
    group: str,
    groups: Mapping[str, str],
) -> DataFrame:
    """One 0/1 column per group; an entity may belong to several or to none.

    ``groups`` maps a group's name in the bridge to the flag column.
    """
    flags = bridge.groupBy(F.col(bridge_key).alias("_entity")).agg(
        *[
            F.max(F.when(F.col(group) == name, 1).otherwise(0)).alias(flag)
            for name, flag in groups.items()
        ]
    )
    joined = entities.join(flags, F.col(entity_key) == F.col("_entity"), "left").drop("_entity")
    return joined.fillna(0, subset=list(groups.values()))
