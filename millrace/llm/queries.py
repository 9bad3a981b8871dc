"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import (
    alignment,
    classifier,
    credentials,
    hard_negatives,
    mixing,
    ngram_join,
    phrases,
    pieces,
    privacy,
    quotes,
    ratios,
    sharding,
    token_counts,
)
from millrace.llm.registry import QUERIES, SQL, query, table
from millrace.storage import materialize

__all__ = ["QUERIES", "SQL"]

# Public vocabularies; other ones are parameters of the operators.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def _draw(seed: str, key: str) -> str:
    """SQL for ``texts.fraction``."""
    named = f"md5('{seed}:' || coalesce(CAST({key} AS VARCHAR), 'null'))"
    return f"CAST(('0x' || substr({named}, 1, 13)) AS BIGINT) / 4503599627370496.0"


# CRC-32 bit by bit would be too slow in SQL; the table is computed from the
# polynomial, eight shifts per entry.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, source, {_draw("1", "doc_id")} AS draw, encode(coalesce(text, '')) AS body
  FROM documents),
t AS (SELECT {_CRC_TABLE} AS crc),
c AS (
  SELECT doc_id, source, draw, CAST(octet_length(body) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(
          regexp_extract_all(hex(body), '..'), lambda h: CAST('0x' || h AS BIGINT))),
        lambda x, b: xor(x >> 8, t.crc[(xor(x, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, t),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY draw, doc_id)
             - {_draw("1:start", "source")}) / count(*) OVER (PARTITION BY source) AS fractional
  FROM c),
p AS (
  SELECT *, row_number() OVER (
      ORDER BY fractional, source IS NULL, source, draw, doc_id) - 1 AS pos,
    count(*) OVER () AS n
  FROM r),
s AS (
  SELECT *, CASE WHEN pos < (n % 16) * (n // 16 + 1) THEN pos // (n // 16 + 1)
      ELSE n % 16 + (pos - (n % 16) * (n // 16 + 1)) // greatest(n // 16, 1) END AS shard
  FROM p)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
  CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""


@query("op1_stratified_shards", OP1_SQL)
def op1(spark, folder):
    """Shards of the documents whose row counts differ by one at most."""
    placed = sharding.stratified_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, source_size * 2.0 AS most,
    sum(source_size) OVER () * 1.5 AS wanted,
    CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
      WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END AS weight
  FROM s),
-- A source is full if its cap is not above its share of what the sources with
-- a smaller cap by weight leave.
f AS (
  SELECT a.*, a.most * sum(CASE WHEN b.most / b.weight >= a.most / a.weight THEN b.weight END)
      <= a.weight * (a.wanted - coalesce(
           sum(CASE WHEN b.most / b.weight < a.most / a.weight THEN b.most END), 0)) AS filled
  FROM w a CROSS JOIN w b
  GROUP BY a.source, a.source_size, a.most, a.wanted, a.weight),
t AS (
  SELECT source, source_size, CASE WHEN filled THEN most ELSE weight *
      (wanted - coalesce(sum(CASE WHEN filled THEN most END) OVER (), 0))
      / sum(CASE WHEN NOT filled THEN weight END) OVER () END AS target
  FROM f),
r AS (
  SELECT d.doc_id, d.size, CAST(t.source_size AS BIGINT) AS source_size,
    CAST(target AS DOUBLE) AS target,
    CASE WHEN t.source_size > 0 THEN CAST(target AS DOUBLE) / t.source_size ELSE 0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN {_draw("8", "doc_id")} < rate - floor(rate)
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


@query("op8_source_mix", OP8_SQL)
def op8(spark, folder):
    """Words that the mix takes from each document."""
    planned = mixing.plan_mix(table(spark, folder, "documents"))
    return planned.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
    )


def _sql_spans(text: str, pattern: str, kind: str, rank: int, part: int = 0, ok: str = "true"):
    """SQL list of ``{start, rank, stop, kind, val}`` of the matches that pass ``ok`` on ``v``."""
    pattern = pattern.replace("'", "''")
    found = f"regexp_extract_all({text}, '{pattern}')"
    parts = f"regexp_extract_all({text}, '{pattern}', {part})"
    gaps = f"string_split_regex({text}, '{pattern}')"
    return f"""list_filter(list_transform(range(1, len({found}) + 1), lambda i: {{
        'start': list_sum(list_transform({gaps}[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform({found}[1:i-1], lambda m: length(m))), 0),
        'rank': {rank},
        'stop': list_sum(list_transform({gaps}[1:i], lambda g: length(g)))
          + list_sum(list_transform({found}[1:i], lambda m: length(m))),
        'kind': '{kind}', 'val': {parts}[i]}}), lambda s: {ok})"""


def _sql_joined(spans: str) -> str:
    return f"""array_to_string(list_transform({spans}, lambda s:
        s.kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.stop AS BIGINT)), ',')"""


def _sql_count(kind: str) -> str:
    return (
        f"CAST(len(list_filter(base, lambda s: s.kind = '{kind}')) AS BIGINT) AS n_{kind}"
    )


# RE2 has no lookahead: the digit is asked for afterwards.
_LOOSE_RE2 = "[A-Za-z0-9+/_-]{20,}"
OP2_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
b AS (
  SELECT doc_id, source, t, list_sort(
    {_sql_spans("t", credentials.ASSIGN, "assign", 0, 1, "length(s.val) >= 6")}
    || {_sql_spans("t", credentials.ACCESS, "access", 1)}
    || {_sql_spans("t", credentials.HEX, "hex", 2)}) AS base,
    {_sql_spans("t", _LOOSE_RE2, "loose", 3)} AS loose
  FROM d),
c AS (
  SELECT *, list_distinct(list_filter(
    list_transform(base || loose, lambda s:
      {{'start': s.stop - length(s.val), 'stop': s.stop, 'val': s.val}}),
    lambda s: regexp_matches(s.val, '[0-9]') AND regexp_matches(s.val, '[A-Za-z]')
      AND len(list_distinct(string_split(s.val, ''))) >= 8)) AS places
  FROM b),
v AS (
  SELECT val, owners <= 1 AND repos <= 3 AS live, owners >= 3 OR repos >= 10 AS example
  FROM (
    SELECT val, count(DISTINCT {{'owner': source}}) AS owners,
      count(DISTINCT {{'owner': source, 'repo': doc_id}}) AS repos
    FROM (SELECT doc_id, source, unnest(places).val AS val FROM c) GROUP BY val)),
m AS (
  SELECT doc_id, list({{'start': p.start, 'rank': 3, 'stop': p.stop, 'kind': 'live', 'val': ''}})
      FILTER (v.live) AS live,
    count(*) FILTER (v.live) AS n_live, count(*) FILTER (v.example) AS n_example
  FROM (SELECT doc_id, unnest(places) AS p FROM c) x JOIN v ON v.val = x.p.val
  GROUP BY doc_id)
SELECT c.doc_id, {", ".join(_sql_count(k) for k in ("assign", "access", "hex"))},
  sha256({_sql_joined("base")}) AS base_sha256,
  {_sql_joined("list_sort(base || coalesce(live, []))")} AS spans,
  CAST(coalesce(n_live, 0) AS BIGINT) AS n_live,
  CAST(coalesce(n_example, 0) AS BIGINT) AS n_example
FROM c LEFT JOIN m ON c.doc_id = m.doc_id
"""


@query("op2_secret_ownership", OP2_SQL)
def op2(spark, folder):
    """Secrets of each document; the owner of a document is its source."""
    return credentials.digest(credentials.scan_secrets(table(spark, folder, "documents")))


@query("op9_disclosure")
def op9(spark, folder):
    """Personal data of each document and the terms that reveal it."""
    return privacy.digest(privacy.find_disclosures(table(spark, folder, "documents")))


@query("op6_quality_fourier")
def op6(spark, folder):
    """Quality score of each document, learned from the labels outside the held-out fold."""
    described = materialize(
        classifier.describe(table(spark, folder, "documents")), "quality-statistics"
    )
    model = classifier.fit(described, table(spark, folder, "labels"))
    return classifier.score(described, model)


@query("op7_target_ratio")
def op7(spark, folder):
    """Base rules and target likelihood ratio; documents labelled good are the target."""
    docs = table(spark, folder, "documents")
    trusted = table(spark, folder, "labels").filter("quality = 1")
    return ratios.judge(docs, ratios.log_ratios(docs, trusted))


@query("op5_ngram_trie")
def op5(spark, folder):
    """Components of documents that share four fifths of their word shingles."""
    return ngram_join.join_documents(table(spark, folder, "documents"))


@query("op4_phrase_fingerprints")
def op4(spark, folder):
    """Phrase fingerprints of each document and of the text edited with the next one."""
    return phrases.fingerprint_documents(table(spark, folder, "documents"))


# The given conversations hold no quotation, so the query makes them quote as mail
# programs do: every turn quotes all of the turn of half its number.
OP3_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, role, text,
    trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS said,
    list_transform(string_split(text, chr(10)), lambda x:
      trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g'))) AS lines
  FROM conversations),
q AS (
  SELECT c.conv_id, c.turn, c.role, c.text, coalesce(o.said, '') AS quoted,
    lag(c.turn) OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS before
  FROM c LEFT JOIN c o ON o.conv_id = c.conv_id AND o.turn = c.turn // 2 AND c.turn > 0),
p AS (
  SELECT q.conv_id, q.turn, q.role, q.text, q.quoted <> '' AS quotes, q.before,
    max(o.turn) AS original
  FROM q LEFT JOIN c o ON o.conv_id = q.conv_id AND o.turn < q.turn AND q.quoted <> ''
    AND (o.said = q.quoted OR list_contains(o.lines, q.quoted))
  GROUP BY ALL),
u AS (SELECT *, coalesce(original, before) AS up FROM p),
d AS (
  SELECT conv_id, turn, 0 AS depth FROM u WHERE up IS NULL
  UNION ALL
  SELECT u.conv_id, u.turn, d.depth + 1 FROM u JOIN d ON u.conv_id = d.conv_id AND u.up = d.turn)
SELECT u.conv_id AS thread, CAST(u.turn AS BIGINT) AS turn, role, trim(coalesce(text, ''), ' ') AS text,
  CAST(quotes AS BIGINT) AS n_quotes, CAST(original IS NOT NULL AS BIGINT) AS n_linked,
  CASE WHEN up IS NOT NULL THEN u.conv_id END AS parent_thread, CAST(up AS BIGINT) AS parent_turn,
  CAST(depth AS BIGINT) AS depth,
  row_number() OVER (PARTITION BY u.conv_id ORDER BY depth, u.turn) AS place
FROM u JOIN d ON u.conv_id = d.conv_id AND u.turn = d.turn
"""


def quoting(messages):
    """The conversations with a quotation of an earlier message before each text.

    Turn ``t`` quotes every line of turn ``t // 2`` of its thread; the first of
    repeated turns by text is the one that is quoted.
    """
    earlier = messages.groupBy("conv_id", F.col("turn").alias("target")).agg(
        F.min("text").alias("quoted")
    )
    half = F.when(F.col("turn") > 0, F.floor(F.col("turn") / 2))
    mine, other = messages.withColumn("target", half).alias("m"), earlier.alias("e")
    same = (F.col("m.conv_id") == F.col("e.conv_id")) & (F.col("m.target") == F.col("e.target"))
    marked = F.concat(F.lit("> "), F.replace("quoted", F.lit("\n"), F.lit("\n> ")), F.lit("\n"))
    text = F.concat(F.coalesce(marked, F.lit("")), F.coalesce("m.text", F.lit("")))
    return mine.join(other, same, "left").select(
        "m.conv_id", "m.turn", "m.role", text.alias("text")
    )


@query("op3_quotation_links", OP3_SQL)
def op3(spark, folder):
    """Messages without quotations, in reply order, with the message each answers."""
    return quotes.link_quotes(quoting(table(spark, folder, "conversations")))


@query("op10_suffix_pieces")
def op10(spark, folder):
    """Ids of each text, and whether decoding them gives the text back."""
    vocabulary = pieces.Vocabulary.load(PIECE_MODEL)
    body = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.md5(F.replace(body, F.lit(pieces.MARK), F.lit(" "))).alias("digest")
    )
    encoded = pieces.encode_documents(docs, vocabulary)
    decoded = pieces.decode_documents(encoded, vocabulary)
    return decoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_ids"),
        (F.md5("decoded") == F.col("digest")).alias("round_trip"),
    )


def vocabulary(name):
    """Place of a public vocabulary file; only the queries that need one look for it."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op11_ragged_counts")
def op11(spark, folder):
    """Bytes and tokens of each text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    merges = token_counts.MergeTable.load(vocabulary(BYTE_MODEL))
    return token_counts.count_tokens(docs, merges)


OP12_SQL = """
WITH r AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS row_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1),
      lambda i: a.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5),
n AS (
  SELECT p.*, s.row_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (
      PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.row_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""


@query("op12_strassen_negatives", OP12_SQL)
def op12(spark, folder):
    """Hard negatives of every hundredth vector among all vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(table(spark, folder, "embeddings"), relabel=moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query("op13_aligned_tokenizers")
def op13(spark, folder):
    """Links between the tokens of two vocabularies, by text and over the corpus."""
    a = alignment.Model.load(vocabulary(BYTE_MODEL))
    b = alignment.Model.load(PIECE_MODEL)
    return alignment.align_documents(table(spark, folder, "documents"), a, b)
