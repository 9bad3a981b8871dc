"""Counting and averaging jobs over text lines.

Input is a DataFrame with the line in ``value``, from ``read.text`` or from
``readStream.text``.  Each job is one projection and one aggregate whose partial
results are combined before the shuffle, so a streaming query keeps one small
state row per key (output mode ``complete`` or ``update``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import map_codes, mean_round
from millrace.functions.text import split_word_runs
from millrace.operators.text import explode_tokens
from millrace.sources.readers import fields

# Polarity codes of the labelled messages.
POLARITY = {"0": "negative", "2": "neutral", "4": "positive"}


def word_count(lines: DataFrame) -> DataFrame:
    """Runs of word characters, lower-cased."""
    words = explode_tokens(lines, split_word_runs("value"), [], name="word")
    return _count(words.withColumn("word", F.lower("word")), "word")


def word_count_raw(lines: DataFrame) -> DataFrame:
    """Pieces between single blanks, case kept, empty pieces included."""
    return _count(lines.select(F.explode(F.split("value", " ")).alias("word")), "word")


def label_count(lines: DataFrame) -> DataFrame:
    """Lines per polarity label from the quoted code in the first field."""
    code = F.trim(F.col("code"), F.lit('"'))
    labelled = fields(lines, {"code": 0}).select(map_codes(code, POLARITY).alias("label"))
    return _count(labelled.filter(F.col("label").isNotNull()), "label")


def rating_mean(lines: DataFrame, header: str = "userId") -> DataFrame:
    """Mean rating per item code, one decimal; unreadable ratings are skipped."""
    return _ratings(lines, header).groupBy("item").agg(mean_round("rating", 1).alias("avg_rating"))


def rating_count_mean(lines: DataFrame, header: str = "userId") -> DataFrame:
    """Ratings and mean rating per item code."""
    return _ratings(lines, header).groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), mean_round("rating", 1).alias("avg_rating")
    )


def _ratings(lines: DataFrame, header: str) -> DataFrame:
    rows = fields(lines, {"item": 1, "rating": 2}, skip_prefix=header)
    return rows.withColumn("rating", F.col("rating").try_cast("double")).filter(
        F.col("rating").isNotNull()
    )


def _count(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
