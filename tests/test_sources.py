import json
import os
from collections import Counter
from datetime import date

import pytest
from conftest import final_plan, values
from pyspark.sql import functions as F

from millrace import storage
from millrace.sources import html, json_arrays, readers, sinks
from millrace.streaming import line_jobs


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parts_listed_twice_count_twice(spark, tmp_path):
    paths = [f"{tmp_path}/{m}" for m in ("01", "07")]
    for i, p in enumerate(paths):
        spark.range(i + 1).write.parquet(p)
    assert readers.read_parts(spark, paths).count() == 3
    assert readers.read_parts(spark, [paths[0], *paths]).count() == 4


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "reviews.json"
    path.write_text(json.dumps([{"text": "Fin é", "sentiment": "Positive"}, {"text": None}], indent=1))
    got = readers.read_json_array(spark, str(path), "text string, sentiment string")
    assert values(got) == [(None, None), ("Fin é", "Positive")]


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)

    def use(size):
        spark.conf.set(name, str(size))

    yield use
    spark.conf.set(name, old)


ODD_RECORDS = [
    {"id": 0, "s": 'a "quoted" }, {"id": 5} \\', "o": {"x": {"y": "}"}}},
    {"id": 1, "s": "{{{[[", "o": None}, {"id": 2, "s": "\\\\\"", "o": {"x": {}}}, {"id": 3},
    {"id": 4, "s": "é}日本\n\t" * 30, "o": {"x": {"y": "\\"}}}, {"id": 6, "s": "", "o": {}}, {},
]


@pytest.mark.parametrize("size", [40, 97, 1000, 1 << 20])
@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_record_arrays_in_any_split(spark, tmp_path, small_splits, size, layout):
    """Strings with braces, quotes and escapes, wherever the file is cut."""
    small_splits(size)
    path = tmp_path / "records.json"
    path.write_text(json.dumps(ODD_RECORDS, **layout))
    got = [json.loads(r["value"]) for r in json_arrays.record_texts(spark, str(path)).collect()]
    assert sorted(got, key=str) == sorted(ODD_RECORDS, key=str)
    read = json_arrays.read_record_arrays(spark, str(path), "id int, o struct<x: struct<y: string>>")
    ys = {r["id"]: r["o"]["x"]["y"] for r in read.collect() if r["o"] and r["o"]["x"]}
    assert ys == {0: "}", 2: None, 4: "\\"}


def test_files_of_other_forms(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", ""), ("c", '[{"id": 1}]\n[{"id": 2}]'), ("d", '{"id": 3}\n{"id": 4}\n')):
        (tmp_path / name).write_text(text)
    got = json_arrays.read_record_arrays(spark, str(tmp_path), "id int")
    assert values(got) == [(1,), (2,), (3,), (4,)]


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path, small_splits):
    small_splits(1 << 20)
    path = tmp_path / "large.json"
    with open(path, "w") as file:
        for i in range(200_000):
            record = json.dumps({"id": i, "s": "}, {" + '"' * (i % 3), "o": {"n": i}})
            file.write(("[" if i == 0 else ",") + record)
        file.write("]")
    read = json_arrays.read_record_arrays(spark, str(path), "id long, s string, o struct<n: long>")
    row = read.agg(
        F.count("*"), F.sum("id"), F.sum("o.n"), F.countDistinct("id"), F.sum(F.length("s"))
    ).first()
    total = 200_000 * 199_999 // 2
    assert tuple(row) == (200_000, total, total, 200_000, sum(4 + i % 3 for i in range(200_000)))
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 5


def test_fields_by_position(spark):
    df = lines(spark, "userId,movieId,rating", "1, 31 ,2.5,99", "2", '"3",4,x')
    got = readers.fields(df, {"item": 1, "rating": 2}, skip_prefix="userId")
    assert values(got) == [(None, None), ("31", "2.5"), ("4", "x")]
    piped = readers.fields(lines(spark, "a|b"), {"first": 0, "second": 1}, sep="|")
    assert values(piped) == [("a", "b")]


def test_csv_with_quotes_and_header(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), ('say "x"', None)], "t string, n int")
    sinks.write_csv(df, f"{tmp_path}/c")
    assert values(readers.read_csv(spark, f"{tmp_path}/c", df.schema)) == values(df)
    sinks.write_csv(df, f"{tmp_path}/t", header=False, sep="\t")
    assert readers.read_lines(spark, f"{tmp_path}/t").count() == 2


def test_small_result_in_one_file(spark, tmp_path):
    sinks.write_parquet(spark.range(0, 100, 1, 8), f"{tmp_path}/p", small=True)
    assert len([f for f in os.listdir(f"{tmp_path}/p") if f.endswith(".parquet")]) == 1


def test_archive_replaces_only_its_day(spark, tmp_path):
    path = f"{tmp_path}/archive"
    sinks.archive_snapshot(spark.range(3), path, date(2024, 1, 1))
    sinks.archive_snapshot(spark.range(5), path, date(2024, 1, 2))
    sinks.archive_snapshot(spark.range(7), path, date(2024, 1, 2))
    counts = spark.read.parquet(path).groupBy("snapshot_date").count()
    assert values(counts) == [(date(2024, 1, 1), 3), (date(2024, 1, 2), 7)]


def test_load_of_economies(spark, tmp_path):
    from millrace.plans import economies

    df = spark.createDataFrame([("Egypt", 395.93)], "Country string, GDP_USD_billion double")
    for day in (1, 2):
        economies.load(df, str(tmp_path), "economies_test", date(2024, 1, day))
    assert values(spark.table("economies_test")) == values(df)
    assert spark.read.parquet(f"{tmp_path}/archive").count() == 2
    assert readers.read_json_lines(spark, f"{tmp_path}/json", df.schema).count() == 1


def test_shared_folder_comes_from_the_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "s3a://shared/ckpt/" if key == "spark.checkpoint.dir" else default

    class Context:
        master = "spark://host"

        def getConf(self):
            return Conf()

    class Unset:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Unset()

    assert storage.shared_dir(Session()) == "s3a://shared/ckpt"
    Session.conf = Conf()
    assert storage.shared_dir(Session()) == "s3a://shared/ckpt"
    Conf.get = Unset.get
    Context.getCheckpointDir = lambda self: None
    with pytest.raises(RuntimeError):
        storage.shared_dir(Session())


def test_materialize_cuts_the_lineage(spark):
    df = storage.materialize(spark.range(10).withColumn("x", F.rand()), "t")
    assert values(df) == values(df)
    assert "Rand" not in df._jdf.queryExecution().optimizedPlan().toString()


PAGE = """<html><TABLE><tr><th>h</th></tr><tr class="r"><td> A &amp; B </td>
<td align='x'><b>1,5</b></td></tr><tr><td>C</td></tr></TABLE>
<a class="k" href="/v?logNo=12">x</a><a href="/v?logNo=12">y</a><a href="/other">z</a></html>"""


def test_cells(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "id int, html string")
    assert values(html.cells(pages, "id", "html")) == [
        (1, 1, 0, "A & B"), (1, 1, 1, "1,5"), (1, 2, 0, "C"),
    ]
    assert values(html.cells(pages, "id", "html", skip_rows=2)) == [(1, 2, 0, "C")]


def test_cells_without_closing_tags(spark):
    page = "<table><tr><td>a<td>b</td>\n<tr><th>h<td id=x>c</table><p>end</p>"
    pages = spark.createDataFrame([(1, page), (2, "<ul><li>x<li>y</ul>z")], "id int, html string")
    assert values(html.cells(pages, "id", "html")) == [(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 0, "c")]
    items = html.cells(pages, "id", "html", row_tag="ul", cell_tag="li")
    assert values(items) == [(2, 0, 0, "x"), (2, 0, 1, "y")]


NESTED = """<TABLE class="outer"><tr><th>h</th><td a='>'>1 <b>x</b></td></tr>
<tr><td>in<table class=inner><tr><td>a<tr><td>b<td>c</table>after<!-- <td>no --></td><td>end</td></tr>
</table></table><td>stray</td><script>"<table><tr><td>no"</script>
<table><td>early<tr><td>last<table><tr><td>deep<table><tr><td>deeper</table>x</table>y"""


def test_nested_tables(spark):
    pages = spark.createDataFrame(
        [(1, NESTED), (2, None), (3, ""), (4, "<td>x"), (5, "<table></table>"), (1, "<table><tr><td>2")],
        "id int, html string",
    )
    found = html.table_cells(pages, "id", "html")
    got = [(*r[:3], *r[4:7], r["fragment"].strip()) for r in found.collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 0, None, 0, 0, True, "h"), (1, 0, None, 0, 1, False, "1 <b>x</b>"),
            (1, 0, None, 1, 0, False, "inafter"), (1, 0, None, 1, 1, False, "end"),
            (1, 1, 0, 0, 0, False, "a"), (1, 1, 0, 1, 0, False, "b"), (1, 1, 0, 1, 1, False, "c"),
            (1, 2, None, -1, 0, False, "early"), (1, 2, None, 0, 0, False, "lasty"),
            (1, 3, 2, 0, 0, False, "deepx"), (1, 4, 3, 0, 0, False, "deeper"),
            (1, 0, None, 0, 0, False, "2"),
        ],
        key=str,
    )
    tags = {r["table_tag"] for r in found.collect()}
    assert tags == {'<TABLE class="outer">', "<table class=inner>", "<table>"}
    assert "Exchange" not in final_plan(found)


def test_rows_of_nested_tables(spark):
    pages = spark.createDataFrame([(1, NESTED), (2, None)], "id int, html string")
    inner = html.table_rows(pages, "id", "html", ["a", "b"], table="inner")
    assert values(inner) == [(1, 1, 0, "a", None), (1, 1, 1, "b", "c")]
    full = html.table_rows(pages, "id", "html", ["a", "b"], table="(?i)table", exact=True)
    assert values(full) == [(1, 0, 0, "h", "1 x"), (1, 0, 1, "inafter", "end"), (1, 1, 1, "b", "c")]
    late = html.table_rows(pages, "id", "html", ["a"], table="outer", skip_rows=1)
    assert values(late) == [(1, 0, 1, "inafter")]


def test_thousands_of_nested_tables(spark):
    part = "<tr><td>{0}<td><table><tr><td>n{0}</table>z{0}"
    page = "<table>" + "".join(part.format(i) for i in range(3000)) + "</table>"
    cells = html.table_cells(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html")
    got = {tuple(r[1:3]) + tuple(r[4:6]) + (r["fragment"],) for r in cells.collect()}
    want = {(0, None, i, 0, str(i)) for i in range(3000)} | {(0, None, i, 1, f"z{i}") for i in range(3000)}
    assert got == want | {(i + 1, 0, 0, 0, f"n{i}") for i in range(3000)}


def test_links(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, PAGE)], "id int, html string")
    assert html.links(pages, "id", "html").count() == 6
    got = html.matching_links(pages, "html", r"logNo=\d+", "https://blog.example")
    assert values(got) == [("https://blog.example/v?logNo=12",)]


def test_links_in_every_form(spark):
    page = """<a href="/a?x=1&amp;y=2">1</a> <A class=k HREF='/b "q"'>2</A> <a data-x="href='/no'"
        href = /c>3</a><a\nhref=https://other.example/d >4</a> <a name="href">5</a>
        <abbr href="/no">6</abbr> <a title='a > b' href="//cdn.example/e">7</a>"""
    pages = spark.createDataFrame([(1, page)], "id int, html string")
    found = [r["href"] for r in html.links(pages, "id", "html").collect()]
    assert found == ["/a?x=1&y=2", '/b "q"', "/c", "https://other.example/d", "//cdn.example/e"]
    got = html.matching_links(pages, "html", "[cde]$", "https://site.example")
    assert values(got) == [
        ("https://cdn.example/e",), ("https://other.example/d",), ("https://site.example/c",),
    ]


def test_parts_with_different_columns(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/p1")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(f"{tmp_path}/p2")
    both = [f"{tmp_path}/p1", f"{tmp_path}/p2"]
    assert values(readers.read_parts(spark, both)) == [(1, None), (2, "x")]
    assert values(readers.read_parts(spark, [*both, both[0]])) == [(1, None), (1, None), (2, "x")]


def test_records_keep_rows_with_seven_cells(spark):
    detail = "<strong>Sonata</strong><br> 2019 |  AT|Gas "
    full = f"<tr><td>08-14</td><td>site</td><td>{detail}</td><td>u</td><td>9</td><td>A</td><td><strong>1,250</strong></td></tr>"
    pages = spark.createDataFrame([(1, f"<table>{full}<tr><td>x</td></tr></table>")], "id int, html string")
    names = ["day", "site", "model", "use", "km", "grade", "price"]
    extra = ["year", "gear", "fuel", "cc", "colour"]
    got = html.records(pages, "id", "html", names, 2, extra)
    assert values(got) == [
        (1, "08-14", "site", "Sonata", "2019", "AT", "Gas", "", "", "u", "9", "A", "1250"),
    ]


def test_word_counts(spark):
    df = lines(spark, "One two  TWO,été_1", "", "  two")
    assert values(line_jobs.word_count(df)) == [("one", 1), ("two", 3), ("été_1", 1)]
    raw = Counter(w for t in ("One two  TWO,été_1", "", "  two") for w in t.split(" "))
    assert dict(values(line_jobs.word_count_raw(df))) == dict(raw)


def test_label_count(spark):
    df = lines(spark, '"0","1","x, y"', "4,a", '"2"', '"9","z"', "", '"0"')
    assert values(line_jobs.label_count(df)) == [("negative", 2), ("neutral", 1), ("positive", 1)]


def test_ratings_include_the_last_group(spark):
    df = lines(spark, "userId,movieId,rating", "1,10,4.0", "2,10,bad", "3,2,1.25", "4,10,4.5", "5,2,1.25")
    assert values(line_jobs.rating_mean(df)) == [("10", 4.3), ("2", 1.3)]
    odd = lines(spark, "userId,movieId,rating", "1,x1,4.0", "1,x2,2.0")
    assert values(line_jobs.rating_mean(odd)) == [("x1", 4.0), ("x2", 2.0)]
    assert values(line_jobs.rating_count_mean(df)) == [("10", 2, 4.3), ("2", 2, 1.3)]
    assert line_jobs.rating_mean(df.filter("false")).count() == 0


def test_line_jobs_on_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("u,1,4.0\nu,1,bad\n")
    stream = spark.readStream.text(str(source))
    query = (
        line_jobs.rating_count_mean(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("ratings_stream")
        .option("checkpointLocation", str(tmp_path / "state"))
        .start()
    )
    try:
        query.processAllAvailable()
        (source / "b.txt").write_text("u,1,3.0\nu,2,5.0\n")
        query.processAllAvailable()
        assert values(spark.table("ratings_stream")) == [("1", 2, 3.5), ("2", 1, 5.0)]
    finally:
        query.stop()


def made_files(spark):
    return {f for f in os.listdir(storage.shared_dir(spark).removeprefix("file:")) if "scoped" in f}


def test_intermediates_end_with_their_scope(spark, tmp_path):
    def build(n):
        return storage.materialize(spark.range(n).withColumn("x", F.col("id") * 2), "scoped")

    with storage.scope(spark):
        df = build(10).join(build(5).select("id"), "id")
        assert len(made_files(spark)) == 2
        df.write.parquet(f"{tmp_path}/out")
    assert made_files(spark) == set() and spark.read.parquet(f"{tmp_path}/out").count() == 5
    with storage.scope(spark) as outer:
        kept = build(3)
        with storage.scope(spark):
            assert build(4).select("id").join(kept, "id").count() == 3
        assert kept.count() == 3 and len(made_files(spark)) == 1
        place = outer.pop()
    assert kept.count() == 3
    storage.remove(spark, place)
    with pytest.raises(ZeroDivisionError), storage.scope(spark):
        build(2)
        raise ZeroDivisionError
    assert made_files(spark) == set()
    # Outside of any scope files stay: the result that reads them is still to come.
    assert build(2).count() == 2 and len(made_files(spark)) == 1


def test_a_written_query_leaves_nothing(spark, folder, tmp_path):
    from millrace.catalog import REGISTRY

    top = storage.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    for name in ("tfidf_top_terms", "json_array_splits"):
        with storage.scope(spark):
            REGISTRY[name].run(spark, folder).write.parquet(f"{tmp_path}/{name}")
    assert set(os.listdir(top)) == before
