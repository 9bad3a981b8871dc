"""Sanitising personal data and the words that give it away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import blanked, joined, masked, matches, spare
from millrace.storage import materialize

# The kinds in the order that breaks ties of spans with one start.
KINDS = ("email", "ip", "card", "phone", "remove", "generalise")

# Possessive runs: no backtracking and no recursion on texts of any length.
# A run starts after something that cannot belong to it, or where the previous
# match ended, which is where the leftmost match of the plain pattern starts.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@"
    r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}{3,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip_ok(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(
        parts,
        lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p.cast("int") <= 255)),
    )


def _luhn(digits: Column) -> Column:
    ones = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0))
    doubled = F.transform(ones, lambda d, i: d.cast("int") * (1 + i % 2))
    total = F.aggregate(
        doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)
    )
    return total % 10 == 0


def _card_ok(value: Column) -> Column:
    return F.length(_digits(value)).between(14, 19) & _luhn(_digits(value))


def _phone_ok(value: Column) -> Column:
    return F.length(_digits(value)).between(10, 15)


def base_spans(text: Column) -> Column:
    """Personal data by start, then kind: ``start, rank, end, kind, value``."""
    text = F.coalesce(text, F.lit(""))
    tests = {
        "email": (EMAIL, lambda v: F.lit(True)),
        "ip": (IP, _ip_ok),
        "card": (CARD, _card_ok),
        "phone": (PHONE, _phone_ok),
    }

    def spans(kind: str) -> Column:
        pattern, passes = tests[kind]
        # Nearly all texts hold no at sign, so the costly pattern rarely runs.
        body = F.when(text.contains("@"), text).otherwise("") if kind == "email" else text
        return F.transform(
            F.filter(matches(body, pattern), lambda m: passes(m["value"])),
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                m["end"].alias("end"),
                F.lit(kind).alias("kind"),
                m["value"].alias("value"),
            ),
        )

    return F.array_sort(F.concat(*[spans(kind) for kind in tests]))


def _terms(text: Column) -> Column:
    """Distinct terms of a text in lower case."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def disclosure(n: Column, both: Column, entity: Column, term: Column) -> Column:
    """Share of an entity's information that a term reveals, at most 1.

    PMI(entity, term) over the information content of the entity, from document
    counts; 0 for an entity that every document holds.
    """
    information = F.log2(n / entity)
    return F.when(information <= 0, F.lit(0.0)).otherwise(
        F.log2(n * both / (entity * term)) / information
    )


def find_disclosures(
    docs: DataFrame,
    *,
    doc_id="doc_id",
    text="text",
    support: int = 2,
    remove_at: float = 0.9,
    generalise_at: float = 0.6,
) -> DataFrame:
    """Personal data of each document and the terms that reveal it.

    A term anywhere in the text of an entity is judged by document
    co-occurrence over the whole corpus, if at least ``support`` different
    texts show the pair: from ``remove_at`` it is removed, from
    ``generalise_at`` generalised, at every place in the texts of the entity.
    What stands inside personal data is no term, for no count.

    Returns ``doc_id, text_key, base, marks``, one row per row of ``docs``;
    ``base`` and ``marks`` hold ``start, rank, end, kind``, ``base`` also the
    value, ``marks`` the band of the term: 0 for a word of 1 to 9 documents, 1 for 10
    to 99, and so on.  ``text_key`` is null where there is no personal data; such rows
    are not joined with anything.  Marks are found per text and joined by its
    digest, so copies are judged once and repeated or null doc_ids are safe.
    The texts are read twice; only those with personal data are shuffled, one
    of a copy and task.  Words are counted in the tasks before they are
    shuffled.  Pairs are made only of entities and terms of ``support`` texts
    and where the document counts leave room for ``generalise_at``, as a pair is
    in no more documents than its entity.  Null text: no spans.  Empty table:
    empty result.  Other columns are ignored.
    """
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    based = body.select("*", base_spans(F.col("text")).alias("base"))
    scanned = materialize(
        based.select(
            "doc_id",
            F.when(F.size("base") > 0, F.md5("text")).alias("text_key"),
            "base",
            F.when(F.size("base") > 0, F.col("text")).alias("text"),
        ),
        "private-scan",
    )
    flagged = scanned.filter("text_key IS NOT NULL")
    n = scanned.count()
    entities = F.array_distinct(
        F.transform("base", lambda s: F.sha2(F.concat_ws(":", s["kind"], s["value"]), 256))
    )
    # One row per different text.
    texts = (
        flagged.groupBy("text_key")
        .agg(F.count("*").alias("rows"), F.first("base").alias("base"), F.first("text").alias("text"))
        .select("text_key", "rows", entities.alias("entities"), "base", "text")
        .withColumn("outside", blanked(F.col("text"), F.col("base")))
    )
    hidden = F.array_except(_terms(F.col("text")), _terms(F.col("outside")))
    texts = materialize(
        texts.select("text_key", "rows", "entities", "outside", hidden.alias("hidden")),
        "private-texts",
    )
    per_entity = (
        texts.select("rows", F.explode("entities").alias("entity"))
        .groupBy("entity")
        .agg(F.sum("rows").alias("n_entity"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= support)
        .select("entity", "n_entity")
    )
    per_entity = materialize(per_entity, "private-entities")
    held = materialize(
        texts.select("text_key", F.explode("entities").alias("entity"))
        .join(per_entity, "entity")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("entity", "n_entity")).alias("held")),
        "private-held",
    )
    spoken = materialize(
        texts.join(held, "text_key").select(
            "text_key", "rows", F.explode(_terms(F.col("outside"))).alias("term")
        ),
        "private-terms",
    )
    wanted = spoken.groupBy("term").agg(F.count("*").alias("texts"))
    wanted = wanted.filter(F.col("texts") >= support).select("term")
    # Of documents with the term, those that have it only inside personal data do not count.
    inside = (
        texts.select("rows", F.explode("hidden").alias("term"))
        .groupBy("term")
        .agg(F.sum("rows").alias("n_inside"))
    )
    per_term = (
        body.select(F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_all"))
        .join(wanted, "term")
        .join(inside, "term", "left")
        .select("term", (F.col("n_all") - F.coalesce("n_inside", F.lit(0))).alias("n_term"))
    )

    def room(entity: Column) -> Column:
        # The share if all documents of the entity hold the term; the slack is for rounding.
        most = disclosure(F.lit(float(n)), entity, entity, F.col("n_term"))
        return most >= generalise_at - 1e-9

    largest = per_entity.agg(F.max("n_entity")).first()[0] or 1
    per_term = materialize(per_term.filter(room(F.lit(largest))), "private-counts")
    pairs = materialize(
        spoken.join(per_term, "term")
        .join(held, "text_key")
        .select(
            "text_key",
            "rows",
            "term",
            "n_term",
            F.explode(F.filter("held", lambda e: room(e["n_entity"]))).alias("e"),
        )
        .select("text_key", "rows", "term", "n_term", "e.entity", "e.n_entity"),
        "private-pairs",
    )
    together = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(
        F.sum("rows").alias("n_both"), F.count("*").alias("texts")
    )
    share = disclosure(F.lit(float(n)), F.col("n_both"), F.col("n_entity"), F.col("n_term"))
    revealing = (
        together.filter(F.col("texts") >= support)
        .withColumn("share", share)
        .filter(F.col("share") >= generalise_at)
        .select("entity", "term", "share")
    )
    # A generalised term is shown as the class of words that are about as frequent.
    band = F.floor(F.log10(F.max("n_term"))).cast("int")
    # Every place of a revealing term in the texts of its entity.
    told = materialize(
        pairs.select("text_key", "entity", "term", "n_term")
        .join(revealing, ["entity", "term"])
        .groupBy("text_key", "term")
        .agg(F.max("share").alias("share"), band.alias("band")),
        "private-told",
    )
    strongest = (
        texts.join(told.select("text_key").distinct(), "text_key", "left_semi")
        .select("text_key", F.explode(matches(F.col("outside"), TERM)).alias("m"))
        .select("text_key", "m.start", "m.end", F.lower("m.value").alias("term"))
        .join(told, ["text_key", "term"])
        .select("text_key", "start", "end", "share", "band")
    )
    kind = F.when(F.col("share") >= remove_at, "remove").otherwise("generalise")
    rank = F.when(F.col("share") >= remove_at, KINDS.index("remove")).otherwise(
        KINDS.index("generalise")
    )
    marks = strongest.groupBy("text_key").agg(
        F.array_sort(
            F.collect_list(
                F.struct("start", rank.alias("rank"), "end", kind.alias("kind"), "band")
            )
        ).alias("marks")
    )
    shape = "array<struct<start:bigint,rank:int,end:bigint,kind:string,band:int>>"
    unmarked = F.array().cast(shape)
    out = ["doc_id", "text_key", "base", "marks"]
    judged = flagged.join(marks, "text_key", "left").withColumn(
        "marks", F.coalesce(F.col("marks").cast(shape), unmarked)
    )
    bare = scanned.filter("text_key IS NULL").withColumn("marks", unmarked)
    return judged.select(*out).unionByName(bare.select(*out))


def all_spans() -> Column:
    """Base and added spans of a row of ``find_disclosures`` by start, then kind."""
    base = F.transform(
        "base",
        lambda s: F.struct(
            s["start"], s["rank"], s["end"], s["kind"], F.lit(None).cast("int").alias("band")
        ),
    )
    return F.array_sort(F.concat(base, F.col("marks")))


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and the list of all spans per row."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:4]],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(all_spans()).alias("spans"),
    )


def sanitise(docs: DataFrame, *, doc_id="doc_id", text="text", **limits) -> DataFrame:
    """``docs`` with personal data replaced by its kind and terms treated.

    A removed term becomes ``<removed>``.  A generalised one becomes the class of
    the corpus's words that are about as frequent: ``<word:10+>`` stands for any
    word of 10 to 99 documents.  Keeps
    all rows and columns, whatever their names; texts without personal data,
    null and empty ones among them, are untouched.
    """
    key, places = spare(docs, "text_key"), spare(docs, "cuts")
    found = find_disclosures(docs, doc_id=doc_id, text=text, **limits)
    cuts = materialize(
        found.filter("text_key IS NOT NULL")
        .groupBy("text_key")
        .agg(F.first("base").alias("base"), F.first("marks").alias("marks"))
        .select(F.col("text_key").alias(key), all_spans().alias(places)),
        "private-cuts",
    )
    body = F.col(text)
    suspect = F.coalesce(
        body.contains("@") | body.rlike(IP) | body.rlike(CARD) | body.rlike(PHONE), F.lit(False)
    )
    hit = docs.filter(suspect).join(cuts, F.md5(body) == F.col(key), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,band:int>>")
    hit = hit.withColumn(places, F.coalesce(places, none))

    def mask(span: Column) -> Column:
        least = F.pow(F.lit(10.0), span["band"].cast("double")).cast("bigint").cast("string")
        return (
            F.when(span["kind"] == "remove", "<removed>")
            .when(span["kind"] == "generalise", F.concat(F.lit("<word:"), least, F.lit("+>")))
            .otherwise(F.concat(F.lit("<"), span["kind"], F.lit(">")))
        )

    fixed = hit.withColumn(text, masked(body, F.col(places), mask))
    return fixed.select(*docs.columns).unionByName(docs.filter(~suspect))
