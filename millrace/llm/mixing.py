"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.texts import fraction, spare, words
from millrace.storage import materialize

WEIGHTS = (3, 1, 2)
SEED = 8


def source_targets(
    sizes: DataFrame,
    *,
    source: str = "source",
    size: str = "size",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """Words wanted from each source: ``source, source_size, target, rate``.

    Sources by code point, null last, take the weights in turn and share
    ``share`` times all sizes.  A target stops at ``cap`` times the source's
    size and the excess goes to the others by weight: sources are filled in the
    order of cap by weight, so one running sum finds every capped source.
    A source of size 0 has target and rate 0.  One row per source.
    """
    per_source = sizes.groupBy(F.col(source).alias("source")).agg(
        F.sum(size).alias("source_size")
    )
    # The windows below see one row per source, never the documents.
    alphabetical = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(alphabetical) - 1) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    everything = Window.partitionBy()
    s = per_source.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (F.col("source_size") * F.lit(cap)).alias("most"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("wanted"),
    )
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.select(
        "*",
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("used"),
        F.sum("weight").over(after).alias("open"),
    )
    full = F.col("most") * F.col("open") <= F.col("weight") * (F.col("wanted") - F.col("used"))
    s = s.withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(
        F.col("weight") * (F.col("wanted") - taken) / open_weight
    )
    s = s.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return s.select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, key: Column, seed: int) -> Column:
    """floor(rate) copies plus one with the probability of the rest."""
    rest = rate - F.floor(rate)
    return F.floor(rate) + F.when(fraction(seed, key) < rest, 1).otherwise(0)


def plan_mix(
    docs: DataFrame, *, doc_id="doc_id", text="text", source="source", seed=SEED, **targets
) -> DataFrame:
    """How often each document enters the mix.

    Returns ``doc_id, source, size, source_size, target, rate, copies`` with
    one row per row of ``docs``.  Null text: size 0.  Null source: a source of
    its own, last.  Null doc_id: one key.  Rows that repeat a doc_id share its
    draw.  Empty table: empty result.  Other columns are ignored.
    """
    slim = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.size(words(F.col(text))).cast("bigint").alias("size"),
        ),
        "mix-sizes",
    )
    # Written, so that its size is known: broadcast when small, else shuffled.
    goals = materialize(source_targets(slim, **targets), "mix-targets")
    s, g = slim.alias("s"), goals.alias("g")
    both = s.join(g, F.col("s.source").eqNullSafe(F.col("g.source")))
    return both.select(
        "s.doc_id",
        "s.source",
        "size",
        "source_size",
        "target",
        "rate",
        copies(F.col("rate"), F.col("s.doc_id"), seed).alias("copies"),
    )


def emit_mix(
    docs: DataFrame, *, doc_id="doc_id", text="text", source="source", seed=SEED, **targets
) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it.

    Keeps the columns of ``docs``, whatever their names.  Rates come from one pass over the sizes;
    the texts meet only the table of one row per source.
    """
    mix, copy = spare(docs, "mix"), spare(docs, "copy")
    slim = docs.select(
        F.col(source).alias("source"), F.size(words(F.col(text))).cast("bigint").alias("size")
    )
    goals = materialize(source_targets(slim, **targets), "mix-targets")
    g = goals.select(F.struct("source", "rate").alias(mix)).alias("g")
    d = docs.alias("d")
    both = d.join(g, F.col(f"d.{source}").eqNullSafe(F.col(f"g.{mix}.source")))
    n = copies(F.col(f"g.{mix}.rate"), F.col(f"d.{doc_id}"), seed).cast("int")
    repeated = both.select("d.*", F.explode(F.array_repeat(F.lit(1), n)).alias(copy))
    return repeated.select(*docs.columns)
