"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.texts import fraction
from millrace.storage import materialize

SEED = 1


def stratified_shards(
    docs: DataFrame,
    *,
    shards: int = 16,
    seed: int = SEED,
    rows_per_slice: int = 2_000,
    doc_id="doc_id",
    text="text",
    source="source",
) -> DataFrame:
    """Shards of equal row counts that all hold the sources in the same mixture.

    The rows of each source are shuffled by a seeded hash and ranked; row ``r``
    of ``n`` gets the fractional rank ``(r - u) / n`` with a seeded start ``u``
    in [0, 1) per source, which keeps many small sources from meeting at one
    place.  All rows sorted by fractional rank are cut into ``shards`` runs
    whose lengths differ by one at most.

    No task sorts a whole source or the whole table: hash slices of about
    ``rows_per_slice`` rows are ranked apart and start at the sum of the counts
    of earlier slices.  The texts are read once, in the scan, and not shuffled.

    Returns ``doc_id, source, size, text_crc32, rank, shard, slot``.  Null text:
    size 1 and the checksum of the empty text.  Null source: a stratum of its
    own.  Null doc_id: one key.  Repeated rows are told apart by nothing and
    take neighbouring places in any order.  Empty table: empty result.  Other
    columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        fraction(seed, F.col(doc_id)).alias("draw"),
        (F.octet_length(body) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    # One row per source; written, so that its size is known to the planner.
    strata = materialize(
        keyed.groupBy("source")
        .agg(F.count("*").alias("rows"))
        .select(
            F.col("source").alias("stratum"),
            "rows",
            F.ceil(F.col("rows") / rows_per_slice).alias("slices"),
            fraction(f"{seed}:start", F.col("source")).alias("start"),
        ),
        "shard-strata",
    )
    total = strata.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    placed = keyed.join(strata, F.col("source").eqNullSafe(F.col("stratum"))).withColumn(
        "slice", F.floor(F.col("draw") * F.col("slices"))
    )
    earlier = (
        Window.partitionBy("stratum")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        placed.groupBy("stratum", "slice")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("stratum").alias("of"),
            F.col("slice").alias("at"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        )
    )
    inside = Window.partitionBy("stratum", "slice").orderBy(
        "draw", "doc_id", "text_crc32", "size"
    )
    ranked = placed.withColumn("nth", F.row_number().over(inside)).join(
        starts, F.col("stratum").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at"))
    )
    rank = F.col("before") + F.col("nth")
    buckets = max(1, -(-total // rows_per_slice))
    fractional = (rank - F.col("start")) / F.col("rows")
    ranked = materialize(
        ranked.select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            "draw",
            rank.alias("rank"),
            fractional.alias("fractional"),
            F.least(F.floor(fractional * buckets), F.lit(buckets - 1)).alias("bucket"),
        ),
        "shard-ranks",
    )
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("bucket").alias("at"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")
        )
    )
    order = Window.partitionBy("bucket").orderBy(
        "fractional", F.col("source").isNull(), "source", "draw", "doc_id", "text_crc32", "size"
    )
    position = F.col("before") + F.col("nth") - 1
    cut = ranked.withColumn("nth", F.row_number().over(order)).join(
        offsets, F.col("bucket") == F.col("at")
    )
    # The first `longer` shards hold one row more.
    length, longer = divmod(total, shards)
    edge = longer * (length + 1)
    short = max(length, 1)
    in_long = position < edge
    past = position - edge
    shard = F.when(in_long, F.floor(position / (length + 1))).otherwise(
        longer + F.floor(past / short)
    )
    slot = F.when(in_long, position % (length + 1)).otherwise(past % short)
    return cut.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "rank",
        shard.cast("int").alias("shard"),
        slot.cast("bigint").alias("slot"),
    )
