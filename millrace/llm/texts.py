"""Column expressions on texts and spans that the native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import let, running_max

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"

# Hex digits of an md5 used as a number: 13 digits (52 bits) are exact in a double.
_DIGITS = 13


def words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def fraction(seed: int | str, key: Column) -> Column:
    """Pseudo-random number in [0, 1), fixed by seed and key; null counts as a key."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, _DIGITS), 16, 10).cast("bigint") / F.lit(
        float(16**_DIGITS)
    )


# Two-level prefix sums: a step looks at no more than _CHUNK elements and the
# chunk totals, so very many spans in one text stay cheap without a shuffle.
_CHUNK = 256


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def sums_before(values: Column) -> Column:
    """For each element the sum of the elements before it."""
    zero = F.lit(0).cast("bigint")

    def place(both: Column) -> Column:
        return F.transform(
            both["each"],
            lambda _, i: _total(F.slice(both["chunks"], F.lit(1), F.floor(i / _CHUNK).cast("int")))
            + _total(
                F.slice(
                    both["each"],
                    (F.floor(i / _CHUNK) * _CHUNK + 1).cast("int"),
                    (i % _CHUNK).cast("int"),
                )
            ),
        )

    def chunked(each: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(each), F.lit(_CHUNK))
        totals = F.transform(starts, lambda c: _total(F.slice(each, c + 1, F.lit(_CHUNK))))
        return let(F.struct(each.alias("each"), totals.alias("chunks")), place)

    empty = F.array(zero).cast("array<bigint>")
    return F.when(F.size(values) == 0, F.slice(empty, 1, 0)).otherwise(let(values, chunked))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches as ``(start, end, value, part)``.

    Offsets count code points, the end is exclusive; ``part`` is the given
    group.  The pattern must not match the empty text.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))

    def spans(x: Column) -> Column:
        lengths = F.transform(
            x["whole"], lambda m, i: x["gaps"][i] + F.length(m).cast("bigint")
        )
        return let(
            F.struct(
                x["whole"].alias("whole"),
                x["parts"].alias("parts"),
                x["gaps"].alias("gaps"),
                sums_before(lengths).alias("before"),
            ),
            lambda y: F.transform(
                y["whole"],
                lambda m, i: F.struct(
                    (y["before"][i] + y["gaps"][i]).alias("start"),
                    (y["before"][i] + y["gaps"][i] + F.length(m)).alias("end"),
                    m.alias("value"),
                    y["parts"][i].alias("part"),
                ),
            ),
        )

    found = let(F.struct(whole.alias("whole"), parts.alias("parts"), gaps.alias("gaps")), spans)
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,part:string>>")
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), found).otherwise(none)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


# Texts are cut from pieces of so many characters, so that many spans of one
# text do not walk through all of it each time.
_PIECE = 256


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` to before ``end``."""
    first = F.floor(start / _PIECE).cast("int")
    last = F.floor((end - 1) / _PIECE).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    cut = F.substring(near, (start - first * _PIECE + 1).cast("int"), (end - start).cast("int"))
    return F.when(end > start, cut).otherwise(F.lit(""))


def _replaced(text: Column, spans: Column, mask: Callable[[Column], Column]) -> Column:
    def body(y: Column) -> Column:
        def one(span: Column, i: Column) -> Column:
            seen = F.coalesce(F.get(y["reach"], i - 1), F.lit(0).cast("bigint"))
            return F.when(
                span["start"] >= seen,
                F.concat(_between(y["pieces"], seen, span["start"]), mask(span)),
            ).otherwise(F.lit(""))

        rest = _between(y["pieces"], F.element_at(y["reach"], -1), y["length"])
        return F.concat(F.array_join(F.transform(y["spans"], one), ""), rest)

    reach = running_max(F.transform(spans, lambda s: s["end"].cast("bigint")))
    given = F.struct(
        _pieces(text).alias("pieces"),
        F.length(text).cast("bigint").alias("length"),
        spans.alias("spans"),
        reach.alias("reach"),
    )
    return F.when(F.size(spans) > 0, let(given, body)).otherwise(text)


def masked(text: Column, spans: Column, mask: Callable[[Column], Column]) -> Column:
    """The text with each span replaced; ``spans`` are sorted by start.

    A span that begins inside an earlier one is dropped with it: what both cover
    goes, up to the later end.  Time grows with the text and the spans, not
    with their product.
    """
    return _replaced(text, spans, mask)


def blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans, of the same length.

    ``spans`` are sorted by start and may overlap.
    """

    def rest_of(y: Column) -> Column:
        return F.transform(
            y["spans"],
            lambda s, i: F.struct(
                F.greatest(
                    s["start"], F.coalesce(F.get(y["reach"], i - 1), F.lit(0).cast("bigint"))
                ).alias("start"),
                F.get(y["reach"], i).alias("end"),
            ),
        )

    # Overlapping spans without what an earlier one covers.
    reach = running_max(F.transform(spans, lambda s: s["end"].cast("bigint")))
    apart = let(F.struct(spans.alias("spans"), reach.alias("reach")), rest_of)
    return let(
        apart,
        lambda parts: _replaced(
            text, parts, lambda s: F.repeat(F.lit(" "), (s["end"] - s["start"]).cast("int"))
        ),
    )


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
