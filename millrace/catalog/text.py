"""Text cleaning, counting and keyword scores over whole documents."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import SPACE, WORD, clean_review, clean_social, half_up, quoted
from millrace.functions import text as fn
from millrace.functions.numbers import round_half_up
from millrace.operators import text as ops
from millrace.plans import keywords
from millrace.streaming import line_jobs

_STOP = sorted(w for w in {*fn.ENGLISH_STOP_WORDS, *fn.SOCIAL_STOP_WORDS} if len(w) > 2)
_STOP_EN = sorted(w for w in set(fn.ENGLISH_STOP_WORDS) if len(w) > 2)


def _pieces(cleaned: str) -> str:
    return f"unnest(string_split_regex({cleaned}, '[{SPACE}]+'))"


def _classed(t: Tables):
    """Documents with their quality class; labels cover some documents."""
    return t.documents.join(t.labels, "doc_id").select("doc_id", "quality", "text")


@query(
    "T01 E04 E05 Y02",
    f"""
    SELECT doc_id, regexp_replace({clean_social('text')}, '[{SPACE}]{{2,}}', ' ', 'g') AS cleaned
    FROM documents
    """,
)
def text_clean(t: Tables):
    cleaned = fn.collapse_spaces(fn.clean_social("text"))
    return t.documents.select("doc_id", cleaned.alias("cleaned"))


@query(
    "T02 T03",
    f"""
    SELECT doc_id, array_to_string(list_filter(string_split_regex({clean_review('text')}, '[{SPACE}]+'),
             lambda w: len(w) > 2 AND NOT list_contains([{quoted(_STOP_EN)}], w)), ' ') AS cleaned
    FROM documents
    """,
)
def text_clean_b(t: Tables):
    """Cleaned, tokenised, filtered and joined again."""
    kept = fn.drop_short_and_stop(
        fn.split_words(fn.clean_review("text")), fn.ENGLISH_STOP_WORDS
    )
    return t.documents.select("doc_id", F.array_join(kept, " ").alias("cleaned"))


@query(
    "A17 Y03 Y05",
    f"""
    SELECT word, count(*) AS n
    FROM (SELECT lower(unnest(string_split_regex(text, '[^{WORD}]+'))) AS word FROM documents)
    WHERE word <> '' GROUP BY 1
    """,
)
def wordcount_lower(t: Tables):
    """Runs of word characters, lower-cased, over whole texts."""
    return line_jobs.word_count(t.documents.select(F.col("text").alias("value")))


@query(
    "A18",
    """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY 1
    """,
)
def wordcount_raw(t: Tables):
    """Pieces between single blanks, empty ones included."""
    return line_jobs.word_count_raw(t.documents.select(F.col("text").alias("value")))


@query(
    "A19",
    """
    SELECT CASE quality * 2 + toxic * 2 WHEN 0 THEN 'negative' WHEN 2 THEN 'neutral' WHEN 4 THEN 'positive' END AS label,
           count(*) AS n
    FROM labels GROUP BY 1
    """,
)
def label_count(t: Tables):
    """Quoted polarity codes at the start of a line."""
    code = F.col("quality") * 2 + F.col("toxic") * 2
    line = F.format_string('"%d","%d","no text"', code, "doc_id")
    lines = t.labels.select(line.alias("value"))
    return line_jobs.label_count(lines)


@query(
    "T03 F15 J14",
    f"""
    SELECT term, count(*) AS n FROM (SELECT {_pieces(clean_social('text'))} AS term FROM documents)
    WHERE len(term) > 2 AND term NOT IN ({quoted(_STOP)}) GROUP BY 1
    """,
)
def tokens_clean(t: Tables):
    """Stop words removed by an anti join with a table, which sees every term once."""
    stop = t.spark.createDataFrame([(w,) for w in _STOP], "word string")
    terms = ops.explode_tokens(t.documents, fn.split_words(fn.clean_social("text")), [], 3)
    return ops.without_stop_words(ops.term_counts(terms), stop)


@query(
    "T04",
    f"""
    SELECT quality, term, count(*) AS n
    FROM (SELECT quality, {_pieces(clean_social('text'))} AS term FROM documents JOIN labels USING (doc_id))
    WHERE len(term) > 2 AND term NOT IN ({quoted(_STOP)}) GROUP BY 1, 2
    """,
)
def term_freq_by_class(t: Tables):
    return keywords.term_frequencies(_classed(t), "text", ["quality"])


_TFIDF = f"""
    WITH docs AS (SELECT doc_id, quality, text FROM documents JOIN labels USING (doc_id)),
    terms AS (SELECT doc_id, quality, {_pieces(clean_review('text'))} AS term FROM docs),
    tf AS (SELECT quality, doc_id, term, count(*) AS tf FROM terms
           WHERE len(term) > 2 AND term NOT IN ({quoted(_STOP_EN)}) GROUP BY 1, 2, 3),
    sizes AS (SELECT quality, count(*) AS docs FROM docs GROUP BY 1),
    spread AS (SELECT quality, term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY 1, 2),
    vocabulary AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY total DESC, term) AS r FROM spread)
      WHERE r <= 1000),
    raw AS (SELECT tf.quality, doc_id, tf.term, tf, tf * (ln((1 + docs) / (1 + df)) + 1) AS w
            FROM tf JOIN vocabulary v ON tf.quality = v.quality AND tf.term = v.term
            JOIN sizes s ON tf.quality = s.quality),
    weights AS (SELECT quality, doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY quality, doc_id)) AS weight
                FROM raw)
"""


@query(
    "T05",
    f"{_TFIDF} SELECT quality, doc_id, term, tf, {half_up('weight', 6)} AS weight FROM weights",
)
def tfidf(t: Tables):
    out = keywords.weights(_classed(t), "doc_id", "text", ["quality"])
    return out.withColumn("weight", round_half_up("weight", 6))


@query(
    "T06 O05",
    f"""
    {_TFIDF},
    best AS (SELECT quality, term, {half_up('max(weight)', 6)} AS score FROM weights GROUP BY 1, 2)
    SELECT quality, term, score
    FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY score DESC, term) AS r FROM best)
    WHERE r <= 200
    """,
)
def tfidf_top_terms(t: Tables):
    return keywords.keywords(_classed(t), "doc_id", "text", ["quality"])


@query(
    "T07 E20",
    """
    SELECT doc_id, CASE WHEN n_chars % 6 >= 3 THEN 'Positive' ELSE 'Negative' END AS sentiment
    FROM documents WHERE n_chars % 6 <> 5 AND trim(text, ' ') <> ''
    """,
)
def label_from_score(t: Tables):
    """Stars to a label; rows with an unreadable score are dropped."""
    stars = F.col("n_chars") % 6
    scored = t.documents.select(
        "doc_id", "text", F.when(stars == 5, "?").otherwise(stars.cast("string")).alias("score")
    )
    return keywords.label_scores(scored, "score").select("doc_id", "sentiment")


@query(
    "E23",
    f"""
    WITH c AS (SELECT quality, term, count(*) AS n
      FROM (SELECT quality, {_pieces(clean_social('text'))} AS term FROM documents JOIN labels USING (doc_id))
      WHERE len(term) > 2 AND term NOT IN ({quoted(_STOP)}) GROUP BY 1, 2),
    e AS (SELECT quality, min(n) AS lo, max(n) AS hi FROM c GROUP BY 1)
    SELECT quality, term, n, coalesce((n - lo) / nullif(hi - lo, 0), 1) AS weight FROM c JOIN e USING (quality)
    """,
)
def term_weight(t: Tables):
    counts = keywords.term_frequencies(_classed(t), "text", ["quality"])
    return ops.relative_weight(counts, ["quality"], "n", "weight")
