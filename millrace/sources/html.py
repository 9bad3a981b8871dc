"""Rows, records and links out of stored HTML pages, by native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import let, running_max, running_min, running_sum

# Character references resolved in extracted text; the ampersand
# comes last so that nothing is resolved twice.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&amp;", "&"),
]

# Elements whose end also ends a row, a cell or an item.
CONTAINERS = {
    "tr": ["tbody", "table"], "td": ["tr", "tbody", "table"], "th": ["tr", "tbody", "table"],
    "li": ["ul", "ol"],
}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def inner_text(fragment: Column | str) -> Column:
    """Text of a fragment: tags dropped, references resolved, blanks trimmed."""
    return F.trim(unescape(F.regexp_replace(_c(fragment), "<[^>]*>", "")))


def unescape(text: Column) -> Column:
    """Character references resolved."""
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def elements(html: Column | str, tag: str) -> Column:
    """Array with the inside of each element, not nested ones.

    An element also ends where the next one of its kind starts or where its
    container ends, as closing tags of rows, cells and items may be left out.
    """
    ends = [f"</{tag}", f"<{tag}[ \\t\\n\\r>]", *[f"</{c}" for c in CONTAINERS.get(tag, [])]]
    pattern = f"(?is)<{tag}(?:[ \\t\\n\\r][^>]*)?>(.*?)(?={'|'.join(ends)}|\\z)"
    return F.regexp_extract_all(_c(html), F.lit(pattern), F.lit(1))


def cells(
    pages: DataFrame,
    key: str,
    html: str,
    row_tag: str = "tr",
    cell_tag: str = "td",
    skip_rows: int = 0,
) -> DataFrame:
    """(key, row_no, col_no, text) for every cell of every row element."""
    rows = pages.select(key, F.posexplode(elements(html, row_tag)).alias("row_no", "_row"))
    if skip_rows:
        rows = rows.filter(F.col("row_no") >= skip_rows)
    return rows.select(
        key, "row_no", F.posexplode(elements("_row", cell_tag)).alias("col_no", "_cell")
    ).select(key, "row_no", "col_no", inner_text("_cell").alias("text"))


def first_cells(pages: DataFrame, key: str, html: str, names: list[str], skip_rows: int = 3) -> DataFrame:
    """The leading cells of each table row under the given column names."""
    rows = pages.select(key, F.posexplode(elements(html, "tr")).alias("row_no", "_row"))
    parts = elements("_row", "td")
    return rows.filter(F.col("row_no") >= skip_rows).select(
        key,
        "row_no",
        *[inner_text(F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)],
    ).filter(F.col(names[0]).isNotNull())


# What may look like a tag but is none.
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)(?=[\s>/]).*?</\1\s*>"
# Tags that make up tables; an attribute in quotes may hold a closing bracket.
_TABLE_TAG = r"""(?i)</?(?:table|tr|td|th)(?=[\s>/])(?:[^>"']|"[^"]*"|'[^']*')*+>"""


def table_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Every cell of every table, nested tables apart from their surroundings.

    ``(key, table_no, parent_table, table_tag, row_no, col_no, header, fragment)``:
    tables are numbered in the order of their start tags, ``parent_table`` is
    the one around (null: none), ``table_tag`` the start tag as written.  The
    fragment is the cell's own markup: what belongs to a table inside the cell
    is in that table's cells only, what follows it is in the cell again.

    A running depth of open tables makes every end tag meet its start.  Rows and
    cells also end where the next one begins or their table ends, as their end
    tags may be left out; end tags without a start are passed over, tables
    without an end reach to the end of the page.  Cells before the first row
    have row -1.  Comments, scripts and styles are no markup.  A page without
    cells, empty or null, gives no rows.  No shuffle: a page is one row.
    """
    body = F.regexp_replace(F.col(html), _HIDDEN, "")
    page = pages.filter(F.col(html).rlike("(?i)<t[dh][\\s>/]")).select(
        F.col(key).alias("_key"), _segments(body).alias("_parts")
    )

    def step(df: DataFrame, value: Callable[[Column], dict[str, Column]], *columns: str):
        """Add columns; the named ones are bound once per row, not once per element."""
        given = F.struct(*[F.col(c) for c in columns])
        made = let(given, lambda y: F.struct(*[v.alias(k) for k, v in value(y).items()]))
        return df.withColumn("_made", made).select(
            *df.columns, *[F.col("_made")[k].alias(k) for k in value(given)]
        )

    page = step(
        page,
        lambda y: {
            "_sums": running_sum(
                F.transform(
                    y["_parts"],
                    lambda x: (x["kind"] == "<table").cast("int")
                    - (x["kind"] == "</table").cast("int"),
                )
            ),
            "_count": _many(y["_parts"], "<table"),
        },
        "_parts",
    )
    page = step(page, lambda y: {"_low": running_min(y["_sums"])}, "_sums")
    # Elements by depth, so that those of one table at one depth lie together.
    page = step(
        page,
        lambda y: {
            "_nested": F.array_sort(
                F.transform(
                    y["_parts"],
                    lambda x, i: F.struct(
                        (
                            F.get(y["_sums"], i)
                            - F.least(F.lit(0).cast("bigint"), F.get(y["_low"], i))
                        ).alias("depth"),
                        i.alias("pos"),
                        x["kind"].alias("kind"),
                        (F.get(y["_count"], i) - 1).cast("int").alias("table"),
                        x["tag"].alias("tag"),
                        x["text"].alias("text"),
                    ),
                )
            )
        },
        "_parts", "_sums", "_low", "_count",
    ).select("_key", "_nested")
    page = step(
        page,
        lambda y: {
            "_table_at": _last(y["_nested"], "<table"),
            "_row_at": _last(y["_nested"], "<table", "<tr"),
            "_rows": _many(y["_nested"], "<tr"),
            "_cells": _many(y["_nested"], "<td", "<th"),
            # All but the end of a table ends the cell before.
            "_bounds": F.filter(
                F.transform(y["_nested"], lambda x, i: F.when(x["kind"] != "</table", i)),
                lambda i: i.isNotNull(),
            ),
        },
        "_nested",
    )
    # The table of each element, by its place in the page.
    page = step(
        page,
        lambda y: {
            "_owner": F.transform(
                F.array_sort(
                    F.transform(
                        y["_nested"],
                        lambda x, i: F.struct(
                            x["pos"], F.get(y["_nested"], F.get(y["_table_at"], i))["table"]
                        ),
                    )
                ),
                lambda x: x["table"],
            )
        },
        "_nested", "_table_at",
    )

    def cells_of(y: Column) -> Column:
        def one(b: Column, k: Column) -> Column:
            x = F.get(y["_nested"], b)
            table = F.get(y["_nested"], F.get(y["_table_at"], b))

            def since(count: str, at: str) -> Column:
                return (F.get(y[count], b) - F.get(y[count], F.get(y[at], b)) - 1).cast("int")

            stop = F.coalesce(F.get(y["_bounds"], k + 1), F.size(y["_nested"]))
            own = F.slice(y["_nested"], b + 1, stop - b)
            return F.when(
                x["kind"].isin("<td", "<th") & (x["depth"] > 0),
                F.struct(
                    table["table"].alias("table_no"),
                    F.get(y["_owner"], table["pos"] - 1).alias("parent_table"),
                    table["tag"].alias("table_tag"),
                    since("_rows", "_table_at").alias("row_no"),
                    since("_cells", "_row_at").alias("col_no"),
                    (x["kind"] == "<th").alias("header"),
                    F.array_join(F.transform(own, lambda p: p["text"]), "").alias("fragment"),
                ),
            )

        return F.filter(F.transform(y["_bounds"], one), lambda c: c.isNotNull())

    names = ["_nested", "_table_at", "_row_at", "_rows", "_cells", "_bounds", "_owner"]
    found = let(F.struct(*[F.col(n) for n in names]), cells_of)
    return page.select(F.col("_key").alias(key), F.inline(found))


def _segments(text: Column) -> Column:
    """Each table tag with the markup after it; the first element has no tag."""
    tags = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(_TABLE_TAG), F.lit(0)))
    return F.transform(
        F.arrays_zip(tags.alias("tag"), F.split(text, _TABLE_TAG, -1).alias("text")),
        lambda x: F.struct(
            F.lower(F.regexp_extract(x["tag"], "^</?[A-Za-z]+", 0)).alias("kind"),
            x["tag"].alias("tag"),
            x["text"].alias("text"),
        ),
    )


def _last(parts: Column, *kinds: str) -> Column:
    """Index of the last element of some kinds up to each element."""
    return running_max(F.transform(parts, lambda x, i: F.when(x["kind"].isin(*kinds), i)))


def _many(parts: Column, *kinds: str) -> Column:
    """Number of elements of some kinds up to each element."""
    return running_sum(F.transform(parts, lambda x: x["kind"].isin(*kinds).cast("int")))


def table_rows(
    pages: DataFrame,
    key: str,
    html: str,
    names: list[str],
    *,
    table: str = "",
    skip_rows: int = 0,
    exact: bool = False,
) -> DataFrame:
    """``(key, table_no, row_no, *names)``: the texts of the leading cells of each row.

    Only tables whose start tag matches ``table`` (an attribute, say).  Rows
    without cells, the first ``skip_rows`` rows of a table and, with ``exact``,
    rows of another number of cells are left out; missing cells are null.
    ``key`` names one page: cells are brought together by it.
    """
    cells = table_cells(pages, key, html).filter(
        F.col("table_tag").rlike(table) & (F.col("row_no") >= skip_rows)
    )
    rows = cells.groupBy(key, "table_no", "row_no").agg(
        F.count("*").alias("_n"),
        *[
            F.max(F.when(F.col("col_no") == i, inner_text("fragment"))).alias(name)
            for i, name in enumerate(names)
        ],
    )
    return rows.filter(F.col("_n") == len(names) if exact else F.lit(True)).drop("_n")


# An anchor's address in double quotes, single quotes or none, in any letter case.
# Other attributes may hold the word in quotes, so they are stepped over whole.
_HREF = (
    r"""(?is)<a(?:\s+(?!href\s*=)[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*+"""
    r"""\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
)


def hrefs(html: Column | str) -> Column:
    """Addresses of a page's anchors as written, character references resolved."""
    found = F.regexp_extract_all(_c(html), F.lit(_HREF), F.lit(1))
    return F.transform(found, lambda x: F.trim(unescape(F.regexp_replace(x, "^[\"']|[\"']$", ""))))


def absolute(base: Column, href: Column) -> Column:
    """Address with its site in front; an absolute address stays as it is."""
    return F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href).when(
        href.startswith("//"), F.concat(F.regexp_extract(base, "^[A-Za-z]+:", 0), href)
    ).otherwise(F.concat(base, href))


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, href) for every anchor."""
    return pages.select(key, F.explode(hrefs(html)).alias("href"))


def matching_links(pages: DataFrame, html: str, pattern: str, base: Column | str) -> DataFrame:
    """Distinct absolute addresses of the links that match ``pattern``."""
    base = F.lit(base) if isinstance(base, str) else base
    return (
        pages.select(base.alias("_base"), F.explode(hrefs(html)).alias("href"))
        .filter(F.col("href").rlike(pattern))
        .select(absolute(F.col("_base"), F.col("href")).alias("url"))
        .distinct()
    )


def split_detail(detail: Column | str, parts: int = 5, sep: str = "|") -> list[Column]:
    """A delimited text as a fixed number of trimmed columns, '' where missing."""
    pieces = F.split(F.regexp_replace(_c(detail), r"[ \t\n\r]{2,}", " "), f"\\Q{sep}\\E")
    return [F.trim(F.coalesce(F.get(pieces, F.lit(i)), F.lit(""))) for i in range(parts)]


def records(
    pages: DataFrame, key: str, html: str, names: list[str], detail: int, detail_names: list[str]
) -> DataFrame:
    """Table rows with exactly ``len(names)`` cells as records.

    Cell ``detail`` holds a bold title, a line break and a delimited list that
    becomes ``detail_names``; the last cell is a number with thousands commas.
    """
    rows = pages.select(key, F.explode(elements(html, "tr")).alias("_row"))
    rows = rows.withColumn("_cells", elements("_row", "td"))
    rows = rows.filter(F.size("_cells") == len(names))
    cell = [F.get(F.col("_cells"), F.lit(i)) for i in range(len(names))]
    out = []
    for i, name in enumerate(names):
        if i == detail:
            title = F.regexp_extract(cell[i], r"(?is)<strong[^>]*>(.*?)</strong>", 1)
            rest = F.regexp_extract(cell[i], r"(?is)<br[^>]*>([^<]*)", 1)
            out.append(inner_text(title).alias(name))
            out += [
                c.alias(n)
                for c, n in zip(split_detail(inner_text(rest), len(detail_names)), detail_names)
            ]
        elif i == len(names) - 1:
            out.append(F.replace(inner_text(cell[i]), F.lit(","), F.lit("")).alias(name))
        else:
            out.append(inner_text(cell[i]).alias(name))
    return rows.select(key, *out)
