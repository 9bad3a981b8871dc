"""Quotation linking: replies joined to the messages they quote, without the quotes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.texts import let
from millrace.storage import materialize

# Turns of a thread that one window sees; longer threads are cut into slices.
_SLICE = 1_000

# Leading quote marks of a line, blanks between them allowed.
MARKS = r"^(?:\x20?>)++"  # possessive: no recursion on very many marks


def levelled(text: Column) -> Column:
    """Lines as ``level, body``: the number of leading quote marks and the rest."""

    def line(each: Column) -> Column:
        marks = F.regexp_extract(each, MARKS, 0)
        body = F.substring(each, F.length(marks) + 1, F.length(each))
        return F.struct(
            F.length(F.replace(marks, F.lit(" "), F.lit(""))).alias("level"), body.alias("body")
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)


def normal(text: Column) -> Column:
    """Lower case, letters and digits only, one blank between runs of them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(lines: Column) -> Column:
    """Quoted runs of lines of one level: ``level, body``, lines joined.

    A run ends where the level changes.  Runs without a letter or digit go.
    """

    def runs(x: Column) -> Column:
        starts = F.filter(
            F.transform(
                x,
                lambda e, i: F.when(
                    (i == 0) | (e["level"] != F.get(x, i - 1)["level"]), i
                ).otherwise(F.lit(-1)),
            ),
            lambda i: i >= 0,
        )
        return let(
            F.struct(x.alias("x"), F.concat(starts, F.array(F.size(x))).alias("cuts")),
            lambda y: F.transform(
                F.slice(y["cuts"], F.lit(1), F.size(y["cuts"]) - 1),
                lambda start, k: F.struct(
                    F.get(y["x"], start)["level"].alias("level"),
                    F.array_join(
                        F.transform(
                            F.slice(y["x"], start + 1, F.get(y["cuts"], k + 1) - start),
                            lambda e: e["body"],
                        ),
                        "\n",
                    ).alias("body"),
                ),
            ),
        )

    return F.filter(
        let(lines, runs), lambda p: (p["level"] > 0) & (F.length(normal(p["body"])) > 0)
    )


def own_text(lines: Column) -> Column:
    """The lines that are not quoted, joined, without blank ends."""
    kept = F.filter(lines, lambda e: e["level"] == 0)
    return F.trim(F.array_join(F.transform(kept, lambda e: e["body"]), "\n"))


def _units(text: Column) -> Column:
    """What a quotation may repeat of an unquoted text: all of it, a paragraph, a line."""
    whole = F.array(text)
    parts = F.concat(whole, F.split(text, r"\n[\x20\t]*\n"), F.split(text, "\n"))
    return F.array_distinct(
        F.filter(F.transform(parts, normal), lambda p: F.length(p) > 0)
    )


def _parts(body: Column) -> Column:
    """Paragraphs of a quoted passage of two or more lines, as hashes: ``whole, lines``."""

    def hashes(pieces: Column) -> Column:
        kept = F.filter(F.transform(pieces, normal), lambda p: F.length(p) > 0)
        return F.array_distinct(F.transform(kept, lambda p: F.xxhash64(p)))

    paragraphs = F.transform(
        F.filter(F.split(body, r"\n[\x20\t]*\n"), lambda p: F.length(normal(p)) > 0),
        lambda p: F.struct(
            F.xxhash64(normal(p)).alias("whole"), hashes(F.split(p, "\n")).alias("lines")
        ),
    )
    none = F.array().cast("array<struct<whole:bigint,lines:array<bigint>>>")
    return F.when(body.contains("\n"), paragraphs).otherwise(none)


def _held_in_parts(sets: DataFrame, originals: DataFrame) -> DataFrame:
    """``thread, turn, hash`` of originals that hold all parts of a passage.

    ``sets`` has ``set, hash, parts``, each different passage once.  An original
    holds a paragraph as such or by all of its lines.  Only the originals of a
    passage's rarest paragraph, by its rarest line, are tried for the rest.
    """
    parts = sets.select("set", F.posexplode("parts").alias("nth", "part"))
    # A paragraph is one element of its own and one per line.
    elements = parts.select(
        "set",
        "nth",
        F.size("part.lines").alias("lines"),
        F.explode(
            F.concat(
                F.array(F.struct(F.col("part.whole").alias("hash"), F.lit(True).alias("whole"))),
                F.transform(
                    "part.lines", lambda h: F.struct(h.alias("hash"), F.lit(False).alias("whole"))
                ),
            )
        ).alias("e"),
    ).select("set", "nth", "lines", "e.hash", "e.whole")
    counts = originals.groupBy("hash").agg(F.count("*").alias("holders"))
    counted = materialize(
        elements.join(counts, "hash", "left").withColumn(
            "holders", F.coalesce("holders", F.lit(0))
        ),
        "quote-elements",
    )
    rarest = (
        counted.groupBy("set", "nth", "whole")
        .agg(F.min(F.struct("holders", "hash")).alias("rare"))
        .groupBy("set", "nth")
        .agg(F.sum("rare.holders").alias("cost"), F.collect_list("rare.hash").alias("rare"))
        .groupBy("set")
        .agg(F.min(F.struct("cost", "nth", "rare")).alias("best"))
        .select("set", F.explode("best.rare").alias("hash"))
    )
    tried = rarest.join(originals, "hash").select("set", "thread", "turn").distinct()
    covered = (
        tried.join(counted.filter("holders > 0"), "set")
        .join(originals, ["thread", "turn", "hash"])
        .groupBy("set", "thread", "turn", "nth", "lines")
        .agg(
            F.max("whole").alias("whole"),
            F.sum((~F.col("whole")).cast("int")).alias("found"),
        )
        .filter("whole OR found = lines")
        .groupBy("set", "thread", "turn")
        .agg(F.count("*").alias("covered"))
    )
    return (
        covered.join(sets.select("set", "hash", F.size("parts").alias("all")), "set")
        .filter("covered = all")
        .select("thread", "turn", "hash")
    )


def latest_before(rows: DataFrame, keys: list[str], mark: Column) -> DataFrame:
    """``rows`` with ``latest``: the greatest smaller ``turn`` of a marked row of the keys.

    ``rows`` are distinct.  A window sees one slice of the turns of a key; the
    greatest marked turns of the slices before come from a sum per slice, so
    one very long thread spreads over many tasks.
    """
    cut = rows.withColumn("slice", F.floor(F.col("turn") / _SLICE)).withColumn("mark", mark)
    marked = F.when(F.col("mark"), F.col("turn"))
    inside = (
        Window.partitionBy(*keys, "slice")
        .orderBy("turn")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    slices = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "slice")
        .agg(F.max(marked).alias("top"))
        .select(*keys, "slice", F.max("top").over(slices).alias("carried"))
    )
    near = cut.withColumn("near", F.max(marked).over(inside))
    return near.join(carried, [*keys, "slice"]).select(
        *rows.columns, F.coalesce("near", "carried").alias("latest")
    )


def depths(nodes: DataFrame) -> DataFrame:
    """``thread, turn, depth`` from ``thread, turn, up``: parents up to the first message.

    Parents have smaller turns, so there is no cycle.  Each round every open
    message jumps to the ancestor its ancestor points to: log2 of the depth
    rounds, two numbers per message, each round written.  A message whose first
    ancestor is reached is done and only looked up, so long threads do not make
    the short ones go along.
    """
    parts = [
        materialize(
            nodes.select(
                "thread", "turn", "up", F.col("up").isNotNull().cast("bigint").alias("depth")
            ),
            "quote-depths",
        )
    ]
    while True:
        known = reduce(DataFrame.unionByName, parts)
        last = parts.pop()
        going = last.filter("up IS NOT NULL")
        if going.isEmpty():
            return known.select("thread", "turn", "depth")
        parts.append(last.filter("up IS NULL"))
        x, y = going.alias("x"), known.alias("y")
        jumped = x.join(
            y, (F.col("x.thread") == F.col("y.thread")) & (F.col("x.up") == F.col("y.turn"))
        ).select(
            "x.thread",
            "x.turn",
            F.col("y.up").alias("up"),
            (F.col("x.depth") + F.col("y.depth")).alias("depth"),
        )
        parts.append(materialize(jumped, "quote-depths"))


def _numbered(linked: DataFrame) -> DataFrame:
    """``linked`` with ``place``: 1, 2, ... in each thread by depth, then turn."""
    cut = linked.withColumn("slice", F.floor(F.col("turn") / _SLICE))
    before = (
        Window.partitionBy("thread")
        .orderBy("depth", "slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cut.groupBy("thread", "depth", "slice")
        .agg(F.count("*").alias("rows"))
        .select(
            "thread", "depth", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("s")
        )
    )
    inside = Window.partitionBy("thread", "depth", "slice").orderBy("turn", "role", "text")
    return (
        cut.withColumn("nth", F.row_number().over(inside))
        .join(starts, ["thread", "depth", "slice"])
        .withColumn("place", (F.col("s") + F.col("nth")).cast("bigint"))
    )


_OUT = [
    "thread", "turn", "role", "text", "n_quotes", "n_linked",
    "parent_thread", "parent_turn", "depth", "place",
]


def link_quotes(
    messages: DataFrame, *, thread="conv_id", order="turn", role="role", text="text"
) -> DataFrame:
    """Messages in reply order, without quotations, with the message each answers.

    A quoted passage is looked up by the hash of its normalised text among the
    unquoted text of all messages, their paragraphs and their lines; a message
    that holds all its paragraphs, as such or by their lines, is an original of
    it too.  Its original is the latest
    of them in the same thread before the reply, else the first in the smallest
    other thread that holds it.  The parent is the original of a
    passage of the lowest quote level, in the own thread if possible, of
    several the latest.  A message that quotes nothing known answers the
    message of its thread with the next smaller turn.

    Returns ``thread, turn, role, text, n_quotes, n_linked, parent_thread,
    parent_turn, depth, place``, one row per row of ``messages``: ``text`` has
    no quotations, ``n_quotes`` counts quoted passages, ``n_linked`` the
    different ones with an original, ``depth`` the parents up to a message
    without one in the thread, and ``place`` numbers the thread's messages by
    depth and turn, so a parent comes before its replies.

    Null text: as empty.  Null thread or turn: alone, depth 0, place 1, never
    an original.  Rows that repeat (thread, turn) share the parent and follow
    each other by role and text.  Empty table: empty result.  Other columns
    are ignored.  Turns are whole numbers.

    Originals are exploded only as far as some quotation asks for their hash.
    No window or group sees a whole thread.
    """
    base = messages.select(
        F.col(thread).alias("thread"),
        F.col(order).cast("bigint").alias("turn"),
        F.col(role).alias("role"),
        levelled(F.col(text)).alias("lines"),
    )
    nothing = F.array().cast("array<struct<level:int,body:string>>")
    parsed = base.select(
        "thread",
        "turn",
        "role",
        own_text(F.col("lines")).alias("text"),
        F.when(F.exists("lines", lambda e: e["level"] > 0), passages(F.col("lines")))
        .otherwise(nothing)
        .alias("quotes"),
    )
    asks = F.transform(
        "quotes",
        lambda q: F.struct(
            q["level"].alias("level"),
            F.xxhash64(normal(q["body"])).alias("hash"),
            _parts(q["body"]).alias("parts"),
        ),
    )
    parsed = materialize(
        parsed.select(
            "thread",
            "turn",
            "role",
            "text",
            F.size("quotes").cast("bigint").alias("n_quotes"),
            F.array_distinct(asks).alias("asks"),
        ),
        "quote-messages",
    )
    whole = parsed.filter("thread IS NOT NULL AND turn IS NOT NULL")
    asked = materialize(
        whole.select("thread", "turn", F.explode("asks").alias("ask"))
        .select("thread", "turn", "ask.level", "ask.hash")
        .distinct(),
        "quote-asked",
    )
    # The same words in other lines are a set of their own.
    sets = materialize(
        whole.select(F.explode("asks").alias("ask"))
        .select("ask.hash", "ask.parts")
        .filter("size(parts) > 0")
        .distinct()
        .withColumn("set", F.xxhash64("hash", "parts")),
        "quote-sets",
    )
    parts = F.flatten(
        F.transform("parts", lambda p: F.array_append(p["lines"], p["whole"]))
    )
    wanted = materialize(
        asked.select("hash").unionByName(sets.select(F.explode(parts).alias("hash"))).distinct(),
        "quote-wanted",
    )
    hashes = F.transform(_units(F.col("text")), lambda p: F.xxhash64(p))
    units = materialize(
        whole.select("thread", "turn", F.explode(hashes).alias("hash"))
        .join(wanted, "hash", "left_semi")
        .select("thread", "turn", "hash")
        .distinct(),
        "quote-units",
    )
    originals = materialize(
        units.join(asked.select("hash").distinct(), "hash", "left_semi")
        .select("thread", "turn", "hash")
        .unionByName(_held_in_parts(sets, units))
        .distinct(),
        "quote-originals",
    )
    # Inside a thread: originals and quotations of a hash by turn.
    events = (
        asked.select("thread", "hash", "turn", F.lit(False).alias("original"))
        .unionByName(originals.withColumn("original", F.lit(True)))
        .groupBy("thread", "hash", "turn")
        .agg(F.max("original").alias("original"))
    )
    inside = latest_before(events, ["thread", "hash"], F.col("original")).select(
        "thread", "hash", "turn", "latest"
    )
    # Elsewhere: the first in the smallest thread, or in the second for that thread itself.
    smallest = Window.partitionBy("hash").orderBy("home")
    homes = (
        originals.groupBy("hash", F.col("thread").alias("home"))
        .agg(F.min("turn").alias("first"))
        .withColumn("nth", F.row_number().over(smallest))
        .filter("nth <= 2")
        .groupBy("hash")
        .agg(
            F.min(F.struct("home", "first")).alias("low"),
            F.max(F.struct("home", "first")).alias("second"),
        )
    )
    placed = asked.join(inside, ["thread", "hash", "turn"]).join(homes, "hash", "left")
    other = F.when(F.col("low.home") != F.col("thread"), F.col("low")).when(
        F.col("second.home") != F.col("thread"), F.col("second")
    )
    found = placed.withColumn("other", other).select(
        "thread",
        "hash",
        "turn",
        "level",
        F.when(F.col("latest").isNotNull(), F.col("thread"))
        .otherwise(F.col("other.home"))
        .alias("home"),
        F.coalesce("latest", "other.first").alias("original"),
    )
    best = F.struct(
        (-F.col("level")).alias("level"),
        (F.col("home") == F.col("thread")).alias("near"),
        "original",
        "home",
    )
    parents = found.groupBy("thread", "turn").agg(
        F.count_distinct(F.when(F.col("original").isNotNull(), F.col("hash"))).alias("n_linked"),
        F.max(F.when(F.col("original").isNotNull(), best)).alias("best"),
    )
    turns = latest_before(whole.select("thread", "turn").distinct(), ["thread"], F.lit(True))
    nodes = materialize(
        turns.join(parents, ["thread", "turn"], "left").select(
            "thread",
            "turn",
            F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
            F.when(F.col("best").isNotNull(), F.col("best.home"))
            .when(F.col("latest").isNotNull(), F.col("thread"))
            .alias("parent_thread"),
            F.coalesce("best.original", "latest").alias("parent_turn"),
        ),
        "quote-nodes",
    )
    up = F.when(F.col("parent_thread") == F.col("thread"), F.col("parent_turn"))
    deep = depths(nodes.withColumn("up", up))
    linked = whole.join(nodes, ["thread", "turn"]).join(deep, ["thread", "turn"])
    kind = parsed.schema["thread"].dataType
    alone = parsed.filter("thread IS NULL OR turn IS NULL").select(
        "*",
        F.lit(0).cast("bigint").alias("n_linked"),
        F.lit(None).cast(kind).alias("parent_thread"),
        F.lit(None).cast("bigint").alias("parent_turn"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(1).cast("bigint").alias("place"),
    )
    return _numbered(linked).select(*_OUT).unionByName(alone.select(*_OUT))


def conversations(linked: DataFrame) -> DataFrame:
    """One row per thread: its messages without quotations, in reply order.

    ``thread, messages`` with ``place, role, text``; empty messages, which held
    nothing but quotations, stay.  A thread must fit into one row.
    """
    message = F.struct("place", "role", "text")
    return linked.groupBy("thread").agg(F.array_sort(F.collect_list(message)).alias("messages"))
