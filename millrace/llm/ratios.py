"""Quality rules: base counts and a hashed n-gram likelihood ratio."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import BLANKS, WORD, let, words

BUCKETS = 1 << 14
ORDERS = (1,)
LEAST_RATIO = -0.2
# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def repeated_words(each: Column) -> Column:
    """Words inside 3-word windows that a word array holds twice or more.

    A window's 64-bit hash gives its low bits to the window's position, so one
    sort of plain numbers puts equal windows side by side.  Windows of equal
    hash are compared word by word; only where two different ones share the
    hash, one in billions, all others of it are looked at.
    """

    def covered(x: Column) -> Column:
        n, unit, sorted_windows = x["n"], x["unit"], x["windows"]

        def key(w: Column) -> Column:
            return w - F.pmod(w, unit)

        def word(w: Column, k: int) -> Column:
            return F.get(x["each"], (F.pmod(w, unit) + k).cast("int"))

        def same(v: Column, w: Column) -> Column:
            return (word(v, 0) == word(w, 0)) & (word(v, 1) == word(w, 1)) & (word(v, 2) == word(w, 2))

        def repeated(w: Column, k: Column) -> Column:
            left = (k > 0) & (key(w) == key(F.get(sorted_windows, k - 1)))
            right = (k < n - 3) & (key(w) == key(F.get(sorted_windows, k + 1)))
            return (left | right) & (
                (left & same(w, F.get(sorted_windows, k - 1)))
                | (right & same(w, F.get(sorted_windows, k + 1)))
                | F.exists(
                    sorted_windows, lambda v: (v != w) & (key(v) == key(w)) & same(v, w)
                )
            )

        twice = F.filter(sorted_windows, repeated)
        places = F.flatten(
            F.transform(
                F.transform(twice, lambda w: F.pmod(w, unit)), lambda p: F.array(p, p + 1, p + 2)
            )
        )
        return F.size(F.array_distinct(places)).cast("bigint")

    def sort(x: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0).cast("bigint"), (x["n"] - 3).cast("bigint")),
            lambda i: F.xxhash64(
                F.get(x["each"], i.cast("int")),
                F.get(x["each"], (i + 1).cast("int")),
                F.get(x["each"], (i + 2).cast("int")),
            ),
        )
        packed = F.transform(hashes, lambda h, i: h - F.pmod(h, x["unit"]) + i)
        return let(
            F.struct(
                x["each"].alias("each"),
                x["n"].alias("n"),
                x["unit"].alias("unit"),
                F.sort_array(packed).alias("windows"),
            ),
            covered,
        )

    unit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.ceil(F.log2(F.size(each) + 1)).cast("int")
    )
    prepared = F.struct(each.alias("each"), F.size(each).alias("n"), unit.alias("unit"))
    return F.when(F.size(each) < 4, F.lit(0).cast("bigint")).otherwise(let(prepared, sort))


def base_counts(text: Column, each: Column) -> dict[str, Column]:
    """The base rules' counts from a non-null text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    counts = {
        "n_words": F.size(each),
        "word_chars": F.length(_without(text, BLANKS)),
        "n_symbols": F.length(text) - F.length(_without(text, SYMBOLS)),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(each),
    }
    return {name: value.cast("bigint") for name, value in counts.items()}


def buckets(each: Column, orders: Sequence[int], size: int) -> Column:
    """Hash buckets of the n-grams of a word array."""

    def grams(n: int) -> Column:
        if n == 1:
            return each
        runs = F.transform(each, lambda _, i: F.array_join(F.slice(each, i + 1, n), " "))
        return F.slice(runs, F.lit(1), F.greatest(F.size(each) - (n - 1), F.lit(0)))

    joined = F.concat(*[grams(n) for n in orders]) if len(orders) > 1 else grams(orders[0])
    return F.transform(joined, lambda g: (F.crc32(g.cast("binary")) % size).cast("smallint"))


def log_ratios(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    doc_id="doc_id",
    text="text",
    orders: Sequence[int] = ORDERS,
    size: int = BUCKETS,
    prior: float = 5.0,
) -> list[float]:
    """Log-likelihood ratio of each hash bucket, target over raw multinomial.

    The target is the documents whose id ``trusted`` holds, the raw corpus is
    all of ``docs``.  A bucket with raw count r and target count t out of R and
    T has ``log((t + prior) / (r * T / R + prior))``: without evidence it is 0.
    With nothing trusted all ratios are 0.  ``size`` numbers reach the driver.

    Documents meet the trusted ids as arrays of 2-byte buckets, a third of the
    text's bytes; n-grams are summed per bucket before they are shuffled.
    """
    hashed = docs.select(
        F.col(doc_id).alias("doc_id"), buckets(words(F.col(text)), orders, size).alias("grams")
    )
    ids = trusted.select(F.col(doc_id).alias("doc_id"), F.lit(1).alias("good")).distinct()
    # One plan for every size: the ids grow with the corpus, so no broadcast.
    counted = (
        hashed.join(ids.hint("merge"), "doc_id", "left")
        .select(F.explode("grams").alias("bucket"), F.coalesce("good", F.lit(0)).alias("good"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    )
    rows = counted.collect()  # at most `size` rows
    all_raw = sum(r["raw"] for r in rows)
    all_target = sum(r["target"] for r in rows)
    ratios = [0.0] * size
    for r in rows if all_target else ():
        expected = r["raw"] * all_target / all_raw
        ratios[r["bucket"]] = math.log((r["target"] + prior) / (expected + prior))
    return ratios


def judge(
    docs: DataFrame,
    ratios: Sequence[float],
    *,
    doc_id="doc_id",
    text="text",
    orders: Sequence[int] = ORDERS,
    least_ratio: float = LEAST_RATIO,
) -> DataFrame:
    """Base rules and mean log ratio of each document, with the verdict.

    Returns ``doc_id``, the base counts, ``base_failed``, ``ratio`` and
    ``kept``: not failed and a mean log ratio per n-gram of ``least_ratio`` or
    more.  Null and empty texts have no words, so they fail.  Rows are judged
    alone, one row per row of ``docs``; other columns are ignored.  No shuffle.
    """
    # Folded to one constant array by the optimizer.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    body = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # The words are made once per row and bound to a lambda variable.
    measured = let(
        F.struct(F.col("text").alias("text"), words(F.col("text")).alias("each")),
        lambda x: F.struct(
            *[v.alias(k) for k, v in base_counts(x["text"], x["each"]).items()],
            let(
                buckets(x["each"], orders, len(ratios)),
                lambda found: F.when(F.size(found) == 0, F.lit(0.0)).otherwise(
                    F.aggregate(found, F.lit(0.0), lambda a, b: a + F.get(table, b.cast("int")))
                    / F.size(found)
                ),
            ).alias("ratio"),
        ),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    judged = body.select("doc_id", measured.alias("m")).select("doc_id", "m.*")
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= least_ratio)
    )
