"""Term frequencies and TF-IDF keywords per class of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import (
    ENGLISH_STOP_WORDS,
    SOCIAL_STOP_WORDS,
    clean_review,
    clean_social,
    split_words,
)
from millrace.operators.text import explode_tokens, term_counts, tfidf, top_terms

MIN_LENGTH = 3


def label_scores(reviews: DataFrame, score: str, threshold: float = 3.0) -> DataFrame:
    """Positive from the threshold on; rows without text or score are dropped."""
    value = F.col(score).try_cast("double")
    label = F.when(value >= threshold, "Positive").when(value.isNotNull(), "Negative")
    return (
        reviews.withColumn("sentiment", label)
        .filter(F.trim("text") != "")
        .dropna(subset=["text", "sentiment"])
    )


def kept(stop_words: Sequence[str], term: str = "term") -> Column:
    """Three letters or more and no stop word.

    The list is compared inside the scan stage; a list of thousands belongs
    into a table and :func:`millrace.operators.text.without_stop_words`.
    """
    listed = sorted(w for w in set(stop_words) if len(w) >= MIN_LENGTH)
    return (F.char_length(term) >= MIN_LENGTH) & ~F.col(term).isin(listed)


def term_frequencies(docs: DataFrame, text: str, classes: Sequence[str]) -> DataFrame:
    """Occurrences per class and term of short messages."""
    stop = [*ENGLISH_STOP_WORDS, *SOCIAL_STOP_WORDS]
    terms = explode_tokens(docs, split_words(clean_social(text)), classes)
    return term_counts(terms.filter(kept(stop)), classes)


def weights(
    docs: DataFrame,
    key: str,
    text: str,
    classes: Sequence[str],
    size: int = 1000,
    extra_stop_words: Sequence[str] = (),
) -> DataFrame:
    """TF-IDF weights of long texts, one corpus per class."""
    keep = kept([*ENGLISH_STOP_WORDS, *extra_stop_words])
    return tfidf(docs, split_words(clean_review(text)), keep, classes, key, size)


def keywords(
    docs: DataFrame,
    key: str,
    text: str,
    classes: Sequence[str],
    size: int = 1000,
    n: int = 200,
    extra_stop_words: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` terms per class with the highest TF-IDF weight in a document."""
    return top_terms(weights(docs, key, text, classes, size, extra_stop_words), classes, n)
