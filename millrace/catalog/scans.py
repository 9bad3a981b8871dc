"""Sources and sinks: what is written is read back and returned."""

import uuid
from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import WORD, mean_round
from millrace.functions.numbers import exact_sum
from millrace.sources import html, json_arrays, readers, sinks
from millrace.storage import fresh_path, materialize
from millrace.streaming import line_jobs


@query(
    "S01 S02 U05",
    """
    WITH parts AS (
      SELECT month(o_orderdate) AS part, o_orderkey, o_custkey, o_totalprice FROM orders)
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(part AS INTEGER) AS part FROM parts
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(part AS INTEGER) FROM parts WHERE part = 1
    """,
)
def scan_union_parts(t: Tables):
    """Month files as one table; the first month is listed twice and counts twice."""
    folder = fresh_path(t.spark, "months")
    months = t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.month("o_orderdate").alias("part")
    )
    months.withColumn("month", F.col("part")).write.partitionBy("month").parquet(folder)
    listed = [1, *range(1, 13)]
    return readers.read_parts(t.spark, [f"{folder}/month={m}" for m in listed])


@query(
    "S03 S14",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_roundtrip(t: Tables):
    """Headered CSV read back as text and converted."""
    path = fresh_path(t.spark, "csv")
    sinks.write_csv(t.customer, path)
    raw = readers.read_csv(t.spark, path, readers.all_text(t.customer.columns))
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in t.customer.schema]
    )


@query("S04", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def csv_glob(t: Tables):
    """Two CSV folders read through one pattern."""
    path = fresh_path(t.spark, "csv")
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    owes = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    sinks.write_csv(rows.filter(owes), f"{path}/debit")
    sinks.write_csv(rows.filter(~owes), f"{path}/credit")
    return readers.read_csv(t.spark, f"{path}/*", rows.schema)


@query(
    "S05",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, user_id, event_type, value
    FROM events
    """,
)
def csv_named(t: Tables):
    """CSV without header: names from the schema, times parsed from text."""
    path = fresh_path(t.spark, "csv")
    stamped = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    sinks.write_csv(
        t.events.select("event_id", stamped.alias("ts"), "user_id", "event_type", "value"),
        path,
        header=False,
    )
    raw = readers.read_csv(
        t.spark,
        path,
        "event_id bigint, at string, user_id bigint, event_type string, value double",
        header=False,
    )
    parsed = F.to_timestamp("at", "dd/MM/yyyy HH:mm:ss")
    return raw.withColumn("at", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"))


@query("S07 S16", "SELECT doc_id, quality, toxic FROM labels")
def json_roundtrip(t: Tables):
    """Record arrays, one per line, so that the file stays splittable."""
    path = fresh_path(t.spark, "json")
    record = F.to_json(F.array(F.struct("doc_id", "quality", "toxic")))
    sinks.write_lines(t.labels, record, path)
    return readers.read_json_lines(t.spark, path, "doc_id bigint, quality int, toxic int")


@query("S16", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def json_lines(t: Tables):
    path = fresh_path(t.spark, "json")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.write_json_lines(rows, path)
    return readers.read_json_lines(t.spark, path, rows.schema)


@query("S07", "SELECT doc_id, quality, toxic FROM labels")
def json_array_files(t: Tables):
    """Files that hold one array of records each, a thousand ids to a file."""
    path = fresh_path(t.spark, "json-arrays")
    record = F.struct("doc_id", "quality", "toxic")
    arrays = t.labels.groupBy(F.floor(F.col("doc_id") / 1000).alias("part")).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )
    arrays.write.partitionBy("part").text(path)
    schema = "doc_id bigint, quality int, toxic int"
    return readers.read_json_array(t.spark, path, schema).select("doc_id", "quality", "toxic")


@query(
    "S07",
    r"""
    SELECT doc_id, '}, {"a\" [' || text AS text, lang, source AS origin FROM documents
    """,
)
def json_array_splits(t: Tables):
    """Arrays of 50,000 records each, read in parallel wherever a file is cut."""
    record = F.struct(
        "doc_id",
        F.concat(F.lit('}, {"a\\" ['), "text").alias("text"),
        F.struct("lang", F.struct(F.col("source").alias("name")).alias("source")).alias("meta"),
    )
    rows = t.documents.select(
        "doc_id", F.floor(F.col("doc_id") / 50_000).alias("array"), F.to_json(record).alias("record")
    )
    group = Window.partitionBy("array")
    nth = F.row_number().over(group.orderBy("doc_id"))
    lines = rows.withColumn("nth", nth).withColumn("n", F.count("*").over(group))
    line = F.concat(
        F.when(F.col("nth") == 1, "[").otherwise(" ,"),
        F.col("record"),
        F.when(F.col("nth") == F.col("n"), "]").otherwise(""),
    )
    path = fresh_path(t.spark, "json-arrays")
    lines.sortWithinPartitions("array", "nth").select(line.alias("value")).write.text(path)
    found = json_arrays.read_record_arrays(
        t.spark,
        path,
        "doc_id bigint, text string, meta struct<lang string, source struct<name string>>",
    )
    return found.select("doc_id", "text", "meta.lang", F.col("meta.source.name").alias("origin"))


@query(
    "S18",
    """
    SELECT s_suppkey, s_acctbal + 1 AS s_acctbal, '2024-01-02' AS snapshot_date
    FROM supplier WHERE s_nationkey <> 3
    """,
)
def snapshot_archive(t: Tables):
    """Two daily states in one archive; the newest day is the only folder read."""
    path = fresh_path(t.spark, "archive")
    first = t.supplier.select("s_suppkey", "s_acctbal")
    second = t.supplier.filter("s_nationkey <> 3").select(
        "s_suppkey", (F.col("s_acctbal") + 1).alias("s_acctbal")
    )
    sinks.archive_snapshot(first, path, date(2024, 1, 1))
    sinks.archive_snapshot(first, path, date(2024, 1, 2))
    sinks.archive_snapshot(second, path, date(2024, 1, 2))
    archive = t.spark.read.parquet(path)
    newest = archive.agg(F.max("snapshot_date")).first()[0]
    return archive.filter(F.col("snapshot_date") == F.lit(newest)).withColumn(
        "snapshot_date", F.col("snapshot_date").cast("string")
    )


@query(
    "S06 A17",
    f"""
    SELECT word, count(*) AS n
    FROM (SELECT lower(unnest(string_split_regex(text, '[^{WORD}]+'))) AS word FROM documents)
    WHERE word <> '' GROUP BY 1
    """,
)
def wordcount_file(t: Tables):
    """Words of text files, read line by line."""
    path = fresh_path(t.spark, "lines")
    sinks.write_lines(t.documents, F.col("text"), path)
    return line_jobs.word_count(readers.read_lines(t.spark, path))


@query(
    "S06 A20",
    f"""
    SELECT CAST(l_partkey AS VARCHAR) AS item, {mean_round('l_quantity', 1)} AS avg_rating
    FROM lineitem GROUP BY 1
    """,
)
def rating_file(t: Tables):
    """Ratings of delimited text files with a header line in each."""
    path = fresh_path(t.spark, "ratings")
    header = F.lit("userId,movieId,rating,timestamp")
    line = F.concat_ws(", ", "l_orderkey", "l_partkey", "l_quantity", F.to_date("l_shipdate"))
    sinks.write_lines(t.lineitem, line, f"{path}/a")
    sinks.write_lines(t.region.limit(1), header, f"{path}/b")
    return line_jobs.rating_mean(readers.read_lines(t.spark, f"{path}/*"))


@query(
    "S08 F13 S12",
    "SELECT l_partkey AS item, l_quantity AS rating FROM lineitem",
)
def delimited_fields(t: Tables):
    """Fields by position; the header line is skipped by its prefix."""
    header = t.spark.createDataFrame([("userId,movieId,rating,timestamp",)], "value string")
    line = F.concat_ws(", ", "l_orderkey", "l_partkey", "l_quantity", F.to_date("l_shipdate"))
    lines = header.union(t.lineitem.select(line.alias("value")))
    parsed = readers.fields(lines, {"item": 1, "rating": 2}, skip_prefix="userId")
    return parsed.select(
        F.col("item").try_cast("bigint").alias("item"),
        F.col("rating").try_cast("double").alias("rating"),
    )


@query(
    "S09",
    r"""
    WITH blocks AS (
      SELECT page_id, regexp_extract_all(html, '(?is)<ul(?:[ \t\n\r][^>]*)?>(.*?)</ul[ \t\n\r]*>', 1) AS b
      FROM pages),
    block_rows AS (
      SELECT page_id, unnest(b) AS body, generate_subscripts(b, 1) - 1 AS row_no FROM blocks),
    items AS (
      SELECT page_id, row_no,
             regexp_extract_all(body, '(?is)<li(?:[ \t\n\r][^>]*)?>(.*?)</li[ \t\n\r]*>', 1) AS i
      FROM block_rows),
    cells AS (
      SELECT page_id, row_no, unnest(i) AS cell, generate_subscripts(i, 1) - 1 AS col_no FROM items)
    SELECT page_id, CAST(row_no AS INTEGER) AS row_no, CAST(col_no AS INTEGER) AS col_no,
           trim(replace(replace(replace(replace(replace(replace(replace(replace(
             regexp_replace(cell, '<[^>]*>', '', 'g'),
             '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
             '&nbsp;', ' '), '&middot;', '·'), '&amp;', '&'), ' ') AS text
    FROM cells
    """,
)
def html_cells(t: Tables):
    """Lists of the stored pages as rows, their items as cells."""
    return html.cells(t.pages, "page_id", "html", row_tag="ul", cell_tag="li")


@query(
    "S09 S11",
    r"""
    WITH p AS (
      SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS items
      FROM pages),
    q AS (SELECT page_id, CASE WHEN len(items) = 0 THEN [''] ELSE items END AS items FROM p),
    cells AS (
      SELECT page_id, 0 AS table_no, NULL AS parent_table, 0 AS row_no, 0 AS col_no,
             true AS header, 'page' AS text FROM q
      UNION ALL SELECT page_id, 0, NULL, 0, 1, false, CAST(page_id AS VARCHAR) FROM q
      UNION ALL SELECT page_id, 0, NULL, 1, 0, false, 'links, counted' FROM q
      UNION ALL SELECT page_id, 0, NULL, 1, 1, false, CAST(len(items) AS VARCHAR) FROM q
      UNION ALL SELECT page_id, 1, 0, CAST(generate_subscripts(items, 1) - 1 AS INTEGER), 0,
                       false, trim(replace(unnest(items), '&amp;', '&')) FROM q)
    SELECT page_id, CAST(table_no AS INTEGER) AS table_no,
           CAST(parent_table AS INTEGER) AS parent_table, CAST(row_no AS INTEGER) AS row_no,
           CAST(col_no AS INTEGER) AS col_no, header, text FROM cells
    """,
)
def nested_tables(t: Tables):
    """A table inside a cell and the table around it, each with its own cells."""
    items = F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)</a>'), F.lit(1))
    page = F.concat(
        F.lit('<table class="outer"><tr><th>page<td>'), F.col("page_id").cast("string"),
        F.lit('<tr><td title="</td>">links<table class="inner"><tr><td>'),
        F.array_join(items, "</td></tr>\n<tr><td>"),
        F.lit("</td></tr></table>, <!-- <td> -->counted</td><td>"),
        F.size(items).cast("string"), F.lit("</table></table>"), F.col("html"),
    )
    cells = html.table_cells(t.pages.select("page_id", page.alias("page")), "page_id", "page")
    return cells.filter(F.col("table_tag").rlike('class="(outer|inner)"')).select(
        "page_id", "table_no", "parent_table", "row_no", "col_no", "header",
        html.inner_text("fragment").alias("text"),
    )


@query(
    "S10 U06",
    r"""
    SELECT DISTINCT base || href AS url
    FROM (SELECT base, split_part(part, '"', 1) AS href
          FROM (SELECT regexp_extract(url, '^(https?://[^/]+)', 1) AS base,
                       unnest(string_split(html, '<a href="')[2:]) AS part FROM pages))
    WHERE regexp_matches(href, '^/[^/]+$')
    """,
)
def html_links(t: Tables):
    """Distinct absolute addresses of the site-relative links."""
    base = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    return html.matching_links(t.pages, "html", "^/[^/]+$", base)


@query(
    "S11",
    """
    SELECT p_partkey, p_name AS model, p_brand AS year, p_type AS gearbox,
           CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) ELSE '' END AS fuel,
           '' AS displacement
    FROM part
    """,
)
def detail_split(t: Tables):
    """A delimited text of three or four parts, padded to five columns."""
    text = F.concat_ws(
        " |  ", "p_name", "p_brand", "p_type",
        F.when(F.col("p_size") > 10, F.col("p_size").cast("string")),
    )
    names = ["model", "year", "gearbox", "fuel", "displacement"]
    parts = html.split_detail(text, 5)
    return t.part.select("p_partkey", *[c.alias(n) for c, n in zip(parts, names)])


@query(
    "S11 E02",
    """
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS auction_date, p_brand AS site, p_name AS model,
           p_type AS year, CAST(p_size AS VARCHAR) AS gearbox, '' AS fuel, 'use' AS use,
           'km' AS mileage, 'A/B' AS grade,
           CAST(CAST(floor(p_retailprice) AS BIGINT) * 1000 AS VARCHAR) AS price
    FROM part
    """,
)
def html_records(t: Tables):
    """Seven-cell table rows as records; shorter rows are ignored."""
    price = F.format_number(F.floor("p_retailprice") * 1000, 0)
    row = F.concat(
        F.lit("<table><tr><td>no</td><td>record</td></tr><tr role='row'><td> "),
        F.col("p_size").cast("string"), F.lit("</td><td class='s'>"), F.col("p_brand"),
        F.lit("</td><td><strong>"), F.col("p_name"), F.lit("</strong><br> "), F.col("p_type"),
        F.lit(" |   "), F.col("p_size").cast("string"),
        F.lit("</td><td>use</td><td>km</td><td>A/B</td><td><strong>"), price,
        F.lit("</strong></td></tr></table>"),
    )
    pages = t.part.select("p_partkey", row.alias("html"))
    names = ["auction_date", "site", "model", "use", "mileage", "grade", "price"]
    return html.records(pages, "p_partkey", "html", names, 2, ["year", "gearbox", "fuel"])


@query("S13", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sink_parquet(t: Tables):
    path = fresh_path(t.spark, "parquet")
    sinks.write_parquet(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return t.spark.read.parquet(path)


@query(
    "S15 E21",
    """
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || chr(9) || count(*) || chr(9)
           || CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS value
    FROM orders GROUP BY CAST(o_orderdate AS DATE)
    """,
)
def sink_tsv(t: Tables):
    """Daily figures as formatted text lines."""
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("revenue")
    )
    path = fresh_path(t.spark, "tsv")
    sinks.write_lines(
        daily, F.format_string("%s\t%d\t%.2f", F.col("day").cast("string"), "n", "revenue"), path
    )
    return readers.read_lines(t.spark, path)


@query("S17", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_table(t: Tables):
    """Catalog table, replaced when it exists; a name of its own, dropped after it is read."""
    name = f"millrace_supplier_{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.write_table(t.supplier, name, fresh_path(t.spark, "table"))
    try:
        return materialize(t.spark.table(name), "table-rows")
    finally:
        t.spark.sql(f"DROP TABLE {name}")
