"""Term counts, TF-IDF keywords and term weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import round_half_up
from millrace.operators.windows import top_n
from millrace.storage import materialize


def explode_tokens(
    df: DataFrame, pieces: Column, keep: Sequence[str], min_length: int = 1, name: str = "term"
) -> DataFrame:
    """One row per piece of at least ``min_length`` characters.

    The filter follows the explode, where it is compiled together with it;
    lambdas over arrays are not.
    """
    rows = df.select(*keep, F.explode(pieces).alias(name))
    return rows.filter(F.char_length(name) >= min_length)


def term_counts(terms: DataFrame, by: Sequence[str] = (), name: str = "term") -> DataFrame:
    """Occurrences per term (and per class); combined before the shuffle."""
    return terms.groupBy(*by, name).agg(F.count(F.lit(1)).alias("n"))


def without_stop_words(terms: DataFrame, stop_words: DataFrame, name: str = "term") -> DataFrame:
    """Anti join with a one-column stop word table of any size."""
    side = stop_words.select(F.col(stop_words.columns[0]).alias("_stop")).distinct()
    return terms.join(side, F.col(name) == F.col("_stop"), "left_anti")


def vocabulary(
    docs: DataFrame, pieces: Column, keep: Column, classes: Sequence[str], size: int
) -> DataFrame:
    """The ``size`` most frequent terms per class with their idf.

    Ties are broken in term order; idf is ``ln((1 + docs) / (1 + docs with
    term)) + 1``.  A document's pieces are sorted inside its row, which marks
    the first occurrence of every term; total and document frequency are then
    two sums that combine per task, and no row per document and term is
    shuffled.
    """
    ordered = docs.select(*classes, F.sort_array(pieces).alias("_all"))
    marked = F.transform(
        "_all",
        lambda w, i: F.struct(
            w.alias("term"),
            F.when((i == 0) | (w != F.get(F.col("_all"), i - 1)), 1).otherwise(0).alias("first"),
        ),
    )
    spread = (
        ordered.select(*classes, F.inline(marked))
        .filter(keep)
        .groupBy(*classes, "term")
        .agg(F.count(F.lit(1)).alias("total"), F.sum("first").alias("df"))
    )
    sizes = docs.groupBy(*classes).agg(F.count(F.lit(1)).alias("_docs"))
    chosen = top_n(spread, classes, [F.col("total").desc(), F.col("term")], size)
    idf = F.log((1 + F.col("_docs")) / (1 + F.col("df"))) + 1
    c, s = chosen.alias("c"), sizes.alias("s")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in classes]
    return c.join(s, same).select(
        *[F.col(f"c.{k}") for k in classes], "term", "df", idf.alias("idf")
    )


def tfidf(
    docs: DataFrame,
    pieces: Column,
    keep: Column,
    classes: Sequence[str],
    doc: str,
    size: int,
) -> DataFrame:
    """L2-normalised TF-IDF weight per class, document and term.

    ``docs`` has one row per document, ``pieces`` is the array of its words and
    ``keep`` a condition on ``term``.  Documents without a vocabulary term have
    no row, but count for the idf.  Documents without a class are a class.
    """
    # Written first: its known size lets Catalyst broadcast it, and then words
    # outside the vocabulary are dropped before anything is shuffled.
    known = materialize(vocabulary(docs, pieces, keep, classes, size), "vocabulary")
    terms = explode_tokens(docs, pieces, [*classes, doc]).filter(keep)
    t, v = terms.alias("t"), known.alias("v")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"v.{c}")) for c in classes]
    kept = t.join(v, [*same, F.col("t.term") == F.col("v.term")]).select("t.*", "v.idf")
    # Dealt by document once: counts and lengths both stay inside a partition.
    kept = kept.repartition(*classes, doc)
    tf = kept.groupBy(*classes, doc, "term", "idf").agg(F.count(F.lit(1)).alias("tf"))
    raw = tf.withColumn("_raw", F.col("tf") * F.col("idf"))
    # At most `size` rows per document, so the window stays small.
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(*classes, doc)))
    return raw.select(*classes, doc, "term", "tf", (F.col("_raw") / length).alias("weight"))


def top_terms(
    weights: DataFrame, classes: Sequence[str], n: int, digits: int = 6
) -> DataFrame:
    """The ``n`` terms per class with the highest weight in any document."""
    best = weights.groupBy(*classes, "term").agg(
        round_half_up(F.max("weight"), digits).alias("score")
    )
    return top_n(best, classes, [F.col("score").desc(), F.col("term")], n)


def relative_weight(counts: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Position of each count between the group's smallest (0) and largest (1)."""
    ends = counts.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    if by:
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        lo, hi = F.col("_lo"), F.col("_hi")
        joined = counts.join(ends, on)
    else:
        one = ends.select(F.struct("_lo", "_hi")).scalar()
        lo, hi = one["_lo"], one["_hi"]
        joined = counts
    weight = F.coalesce(F.try_divide(F.col(value) - lo, hi - lo), F.lit(1.0))
    return joined.select(*counts.columns, weight.alias(name))
