import math
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import final_plan, values
from pyspark.sql import functions as F

from millrace.functions import text as fn
from millrace.operators import text as ops
from millrace.plans import keywords

SAMPLES = [
    "RT @Ann_1: visit http://x.io/a?b=1 now!!  #Été 42 times",
    "don't  stop\tthe\nMusic_box www.site.com",
    "",
    "ﬁne ΑΒΓ ñandú naïve 日本 x_y @ # http",
    "9" * 30000 + " end",
]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "id int, text string")


# Text, as a short message, as a review: written out by hand.
CLEANED = [
    (SAMPLES[0], "rt  visit  now  été 42 times", "rt  visit  now  été  times"),
    (SAMPLES[1], "dont  stop\tthe\nmusic_box wwwsitecom", "dont  stop\tthe\nmusic_box "),
    ("", "", ""),
    (SAMPLES[3], "ﬁne αβγ ñandú naïve 日本 x_y   http", "ﬁne αβγ ñandú naïve 日本 x_y   http"),
    # No-break and ideographic blanks end a word and stay.
    (
        "A\u00a0b\u3000c http://q\u3000Z www.x\u00a0y@z 5",
        "a\u00a0b\u3000c \u3000z wwwx\u00a0y 5",
        "a\u00a0b\u3000c \u3000z \u00a0y ",
    ),
]


def test_cleaning(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in CLEANED], "text string")
    got = df.select("text", fn.clean_social("text").alias("a"), fn.clean_review("text").alias("b"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(CLEANED)


def test_cleaning_twice_changes_nothing_more(samples):
    once = samples.withColumn("text", fn.clean_review("text"))
    twice = once.withColumn("text", fn.clean_review("text"))
    assert values(once) == values(twice)


def test_kept_tokens_as_array_and_as_rows(samples):
    stop = ["the", "now"]
    array = fn.drop_short_and_stop(fn.split_words(fn.clean_review("text")), stop)
    by_row = samples.select("id", F.explode(array).alias("term"))
    terms = ops.explode_tokens(samples, fn.split_words(fn.clean_review("text")), ["id"])
    assert values(terms.filter(keywords.kept(stop))) == values(by_row)
    table = samples.sparkSession.createDataFrame([(w,) for w in stop], "w string")
    anti = ops.without_stop_words(terms.filter(F.char_length("term") >= 3), table)
    assert values(anti) == values(by_row)


def test_first_number(spark):
    df = spark.createDataFrame([("1 234 posts",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.first_number("t")).collect()] == [1, None, None]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    bag = [f"w{i:02d}" for i in range(40)]
    rows = []
    for i in range(60):
        words = rng.choices(bag, weights=range(1, 41), k=rng.randint(0, 30))
        rows.append((i, "pos" if i % 3 else "neg", " ".join(words)))
    return spark.createDataFrame(rows, "doc int, cls string, text string").repartition(4)


def brute_tfidf(rows, size):
    out = {}
    for cls in {r["cls"] for r in rows}:
        docs = {r["doc"]: Counter(r["text"].split()) for r in rows if r["cls"] == cls}
        total, df = Counter(), Counter()
        for c in docs.values():
            total.update(c)
            df.update(c.keys())
        vocabulary = sorted(total, key=lambda w: (-total[w], w))[:size]
        idf = {w: math.log((1 + len(docs)) / (1 + df[w])) + 1 for w in vocabulary}
        for doc, c in docs.items():
            raw = {w: c[w] * idf[w] for w in vocabulary if c[w]}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            for w, v in raw.items():
                out[cls, doc, w] = v / norm
    return out


def test_tfidf_against_brute_force(corpus):
    weights = ops.tfidf(corpus, fn.split_words("text"), F.col("term") != "", ["cls"], "doc", 25)
    got = {(r["cls"], r["doc"], r["term"]): r["weight"] for r in weights.collect()}
    want = brute_tfidf(corpus.collect(), 25)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    norms = weights.groupBy("cls", "doc").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(math.isclose(r["n"], 1.0, rel_tol=1e-12) for r in norms)


def test_top_terms_take_the_maximum_over_documents(corpus):
    want = defaultdict(float)
    for (cls, _, w), v in brute_tfidf(corpus.collect(), 1000).items():
        want[cls, w] = max(want[cls, w], math.floor(v * 1e6 + 0.5) / 1e6)
    weights = ops.tfidf(corpus, fn.split_words("text"), F.col("term") != "", ["cls"], "doc", 1000)
    top = ops.top_terms(weights, ["cls"], 5)
    for cls in ("pos", "neg"):
        best = sorted((k for k in want if k[0] == cls), key=lambda k: (-want[k], k[1]))[:5]
        mine = {(r["cls"], r["term"]) for r in top.collect() if r["cls"] == cls}
        assert mine == set(best)


def test_words_outside_the_vocabulary_are_not_shuffled(corpus):
    weights = ops.tfidf(corpus, fn.split_words("text"), F.col("term") != "", ["cls"], "doc", 25)
    plan = final_plan(weights)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_relative_weight(spark):
    df = spark.createDataFrame([("a", 2), ("b", 4), ("c", 6)], "term string, n int")
    assert values(ops.relative_weight(df, [], "n", "w"), "term", "w") == [
        ("a", 0.0), ("b", 0.5), ("c", 1.0),
    ]
    single = ops.relative_weight(df.filter("n = 2"), [], "n", "w")
    assert values(single, "w") == [(1.0,)]


def test_labels_from_scores(spark):
    df = spark.createDataFrame(
        [("good", "3.0"), ("bad", "2.5"), ("odd", "x"), ("", "5"), (None, "5")],
        "text string, score string",
    )
    assert values(keywords.label_scores(df, "score"), "text", "sentiment") == [
        ("bad", "Negative"), ("good", "Positive"),
    ]
