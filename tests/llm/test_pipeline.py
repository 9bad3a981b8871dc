"""The stages on the smallest tables, each against a plain version of its decision."""

import re

import numpy as np
import sentencepiece
from llm.test_ngram_join import brute
from llm.test_spans import secret_spans

import corpus_pipeline
from millrace.llm import classifier
from millrace.llm.queries import PIECE_MODEL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark, folder, documents):
    docs = documents
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality classifier",
        "n-gram Jaccard join",
        "secret scans",
        "mixing sources to target weights",
        "SentencePiece encoding and decoding",
    ]
    quality, join, secrets, mix, tokens = stages.values()

    kept = quality(spark, docs, folder).cache()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = classifier.fit(classifier.describe(docs), labels)
    every = docs.collect()
    scores = model.score(np.array([classifier.statistics(r["text"]) for r in every]))
    assert rows(kept) == sorted(
        (tuple(r) for r, s in zip(every, scores) if s >= 0.7), key=str
    )
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    lost = good - {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(lost) <= 0.05 * len(good)

    single = join(spark, kept, folder).cache()
    before = kept.collect()
    want = {i for i, _, c in brute([(r["doc_id"], r["text"]) for r in before]) if i == c}
    assert rows(single) == sorted((tuple(r) for r in before if r["doc_id"] in want), key=str)

    clean = secrets(spark, single, folder).cache()
    old = {r["doc_id"]: r for r in single.collect()}
    for r in clean.collect():
        text = old[r["doc_id"]]["text"]
        if not secret_spans(text) and not re.search("[A-Za-z0-9+/_-]{20,}", text):
            assert r["text"] == text
        assert r["n_chars"] == len(r["text"])
        assert not [s for s in secret_spans(r["text"]) if s[1] > 0]
    assert clean.count() == single.count()

    mixed = mix(spark, clean, folder).cache()
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} <= set(old)
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2

    last = tokens(spark, mixed, folder).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    by_id = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(last) == mixed.count()
    assert all(r["ids"] == library.encode(by_id[r["doc_id"]]) for r in last)
    assert all(r["n_ids"] == len(r["ids"]) for r in last)
    assert corpus_pipeline.ORACLE_SQL is None
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, whole)) == sorted(map(str, last))


def test_stages_on_empty_and_odd_tables(spark, folder, documents):
    nothing = documents.limit(0)
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", None, 0), (1, "token = abcdef " * 30, "en", "s", 9)],
        documents.schema,
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).collect() == []
        stage(spark, odd, folder).collect()
