"""Secret scans: spans by pattern, told apart by who owns a value corpus-wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import joined, masked, matches, spare
from millrace.storage import materialize

# The kinds in the order that breaks ties of spans with one start.
KINDS = ("assign", "access", "hex", "live")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEY = "|".join(
    [_either_case(w) for w in ("password", "passwd", "secret", "token")]
    + [_either_case("api") + "_?" + _either_case("key")]
)
ASSIGN = rf"""(?:{_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Any long run with a digit may be a credential; its frequency decides.  The digit
# is asked for afterwards: a lookahead would walk a run again from every place.
LOOSE = r"[A-Za-z0-9+/_-]{20,}+"
_LEAST_ASSIGNED = 6
_LEAST_DISTINCT = 8


def _span(start: Column, end: Column, kind: str, value: Column) -> Column:
    return F.struct(
        start.alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        end.alias("end"),
        F.lit(kind).alias("kind"),
        value.alias("value"),
    )


def base_spans(text: Column) -> Column:
    """Matches of the three kinds by start, then kind.

    ``start, rank, end, kind, value``; the value of an assignment is what is
    assigned.  Null text: none.
    """
    text = F.coalesce(text, F.lit(""))
    assigned = F.filter(
        matches(text, ASSIGN, 1), lambda m: F.length(m["part"]) >= _LEAST_ASSIGNED
    )

    def whole(kind: str, pattern: str) -> Column:
        return F.transform(
            matches(text, pattern), lambda m: _span(m["start"], m["end"], kind, m["value"])
        )

    return F.array_sort(
        F.concat(
            F.transform(assigned, lambda m: _span(m["start"], m["end"], "assign", m["part"])),
            whole("access", ACCESS),
            whole("hex", HEX),
        )
    )


def candidates(text: Column, base: Column) -> Column:
    """Places of live-looking values: ``start, end, value``.

    The values of the base spans and any run of 20 or more token characters,
    as far as they hold a letter, a digit and eight distinct characters.
    """
    text = F.coalesce(text, F.lit(""))
    places = F.concat(
        F.transform(
            base,
            lambda s: F.struct(
                (s["end"] - F.length(s["value"])).alias("start"), s["end"], s["value"]
            ),
        ),
        F.transform(matches(text, LOOSE), lambda m: F.struct(m["start"], m["end"], m["value"])),
    )
    return F.array_distinct(
        F.filter(
            places,
            lambda p: p["value"].rlike("[0-9]")
            & p["value"].rlike("[A-Za-z]")
            & (
                F.size(F.array_distinct(F.regexp_extract_all(p["value"], F.lit("."), F.lit(0))))
                >= _LEAST_DISTINCT
            ),
        )
    )


def ownership(
    sightings: DataFrame,
    live_owners: int = 1,
    example_owners: int = 3,
    live_repos: int = 3,
    example_repos: int = 10,
) -> DataFrame:
    """Verdict per candidate hash from ``value_hash, owner, repo`` rows.

    ``live``: at most ``live_owners`` distinct owners and ``live_repos``
    distinct repositories; ``example``: at least ``example_owners`` or
    ``example_repos``, a value copied from documentation, be it inside one
    owner; else ``shared``.  Repositories of the same name with different
    owners are different.  A null owner or repository counts as one.  Every
    grouping is summed before it is shuffled, so a value in a third of all rows
    is one row per task and repository.
    """
    per_repo = sightings.groupBy("value_hash", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = per_repo.groupBy("value_hash", "owner").agg(F.sum("one").alias("repos"))
    per_value = per_owner.groupBy("value_hash").agg(
        F.sum("repos").alias("repos"), F.count("*").alias("owners")
    )
    verdict = (
        F.when(
            (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos), "example"
        )
        .when((F.col("owners") <= live_owners) & (F.col("repos") <= live_repos), "live")
        .otherwise("shared")
    )
    return per_value.withColumn("verdict", verdict)


def scan_secrets(
    docs: DataFrame, *, doc_id="doc_id", text="text", owner="source", repo="doc_id", **limits
) -> DataFrame:
    """Secrets of each document, live ones told from copied examples.

    Returns ``doc_id, text_key, base, marks``, one row per row of ``docs``:
    ``base`` as in ``base_spans``, ``marks`` the judged candidate places as
    ``start, rank, end, kind, verdict`` (kind ``live``).  The verdict belongs
    to the value, so equal texts are judged once and the place lists are
    joined back by a digest of the text, not by doc_id: repeated and null
    doc_ids are safe.  Rows without a span or candidate, nearly all, have no
    ``text_key`` and bypass that join; the rest, with copies of one text among them, is an outer join whose large
    side AQE can split.  Null text: no spans.  Empty table: empty result.
    Other columns are ignored.
    """
    base = base_spans(F.col("text"))
    scanned = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(owner).alias("owner"),
        F.col(repo).cast("string").alias("repo"),
        F.col(text).alias("text"),
    )
    scanned = scanned.select("*", base.alias("base"))
    scanned = scanned.select("*", candidates(F.col("text"), F.col("base")).alias("places"))
    scanned = materialize(
        scanned.select(
            "doc_id",
            "owner",
            "repo",
            F.when((F.size("base") > 0) | (F.size("places") > 0), F.md5("text")).alias("text_key"),
            "base",
            "places",
        ),
        "secret-scan",
    )
    bare = scanned.filter("text_key IS NULL")
    flagged = scanned.filter("text_key IS NOT NULL")
    hashes = F.array_distinct(F.transform("places", lambda p: F.sha2(p["value"], 256)))
    verdicts = ownership(
        flagged.select("owner", "repo", F.explode(hashes).alias("value_hash")), **limits
    )
    placed = (
        flagged.groupBy("text_key")
        .agg(F.first("places").alias("places"))
        .select("text_key", F.explode("places").alias("place"))
        .select("text_key", "place", F.sha2("place.value", 256).alias("value_hash"))
    )
    mark = F.struct(
        F.col("place.start").alias("start"),
        F.lit(KINDS.index("live")).alias("rank"),
        F.col("place.end").alias("end"),
        F.lit("live").alias("kind"),
        F.col("verdict"),
    )
    marks = (
        placed.join(verdicts, "value_hash")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_list(mark)).alias("marks"))
    )
    out = ["doc_id", "text_key", "base", "marks"]
    kind = "array<struct<start:bigint,rank:int,end:bigint,kind:string,verdict:string>>"
    none = F.array().cast(kind)
    judged = flagged.join(marks, "text_key", "left").withColumn(
        "marks", F.coalesce("marks", none).cast(kind)
    )
    return judged.select(*out).unionByName(bare.withColumn("marks", none).select(*out))


def _places(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and the list of all spans per row."""
    live = F.filter("marks", lambda m: m["verdict"] == "live")
    every = F.array_sort(F.concat(_places(F.col("base")), _places(live)))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    def judged(verdict: str) -> Column:
        return F.size(F.filter("marks", lambda m: m["verdict"] == verdict)).cast("bigint")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(every).alias("spans"),
        judged("live").alias("n_live"),
        judged("example").alias("n_example"),
    )


def redact(docs: DataFrame, *, text="text", mask: str = "<secret>", **names) -> DataFrame:
    """``docs`` with every secret masked that is not a widely copied example.

    Keeps all rows and columns, whatever their names.  Base spans of little
    variety are masked too.  Texts without a span or candidate, null and empty
    ones among them, are untouched and not shuffled.  The spans of a text are
    found again by its digest.
    """
    key, places = spare(docs, "text_key"), spare(docs, "cuts")
    found = scan_secrets(docs, text=text, **names)
    # What a base span assigns or is, unless the value is an example.
    examples = F.filter("marks", lambda m: m["verdict"] == "example")
    kept = F.filter(
        "base",
        lambda s: ~F.exists(
            examples,
            lambda m: (m["end"] == s["end"]) & (m["start"] == s["end"] - F.length(s["value"])),
        ),
    )
    values = F.transform(
        kept, lambda s: F.struct((s["end"] - F.length(s["value"])).alias("start"), s["end"])
    )
    others = F.transform(
        F.filter("marks", lambda m: m["verdict"] != "example"),
        lambda m: F.struct(m["start"], m["end"]),
    )
    cuts = materialize(
        found.filter("text_key IS NOT NULL")
        .groupBy("text_key")
        .agg(F.first("base").alias("base"), F.first("marks").alias("marks"))
        .select(
            F.col("text_key").alias(key),
            F.array_sort(F.array_distinct(F.concat(values, others))).alias(places),
        ),
        "secret-cuts",
    )
    body = F.col(text)
    loose = F.exists(
        F.regexp_extract_all(body, F.lit(LOOSE), F.lit(0)), lambda run: run.rlike("[0-9]")
    )
    suspect = F.coalesce(
        body.rlike(ASSIGN) | body.rlike(ACCESS) | body.rlike(HEX) | loose, F.lit(False)
    )
    hit = docs.filter(suspect).join(cuts, F.md5(body) == F.col(key), "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    hit = hit.withColumn(places, F.coalesce(places, none))
    fixed = hit.withColumn(text, masked(body, F.col(places), lambda _: F.lit(mask)))
    return fixed.select(*docs.columns).unionByName(docs.filter(~suspect))
