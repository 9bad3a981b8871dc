"""A corpus from raw documents to token ids, in stages that are written in between.

Every stage gets all rows that the one before kept and decides on what it sees:
scores, duplicates, owners and target weights are those of its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import classifier, credentials, mixing, ngram_join, pieces
from millrace.llm.queries import PIECE_MODEL
from millrace.llm.registry import table
from millrace.session import configure
from millrace.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with their columns unchanged."""
    described = materialize(classifier.describe(docs), "quality-statistics")
    model = classifier.fit(described, table(configure(spark), sf_dir, "labels"))
    return classifier.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by four fifths of the word shingles."""
    configure(spark)
    return ngram_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked that are not widely copied examples."""
    configure(spark)
    clean = credentials.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    configure(spark)
    return mixing.emit_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, ids, n_ids`` of each document of the mix."""
    configure(spark)
    slim = docs.select("doc_id", "source", "text")
    encoded = pieces.encode_documents(slim, pieces.Vocabulary.load(PIECE_MODEL))
    return encoded.withColumn("n_ids", F.size("ids").cast("bigint"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", tokens),
]

# Classifier scores and token ids have no SQL form; tests/llm holds the
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one is left to the caller to write."""
    sf_dir = sf_dir.rstrip("/")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialize(docs, f"stage-{k}")
    return docs
