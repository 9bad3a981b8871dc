"""The batch jobs from files to files."""

import json
from datetime import date

from conftest import values
from test_trips_fares import GOOD, SCHEMA, trip

from millrace.jobs import main


def run(spark, *argv):
    main([str(a) for a in argv], spark)


def test_trips_fares_and_daily(spark, tmp_path):
    data = f"{tmp_path}/trips"
    spark.createDataFrame([trip(**c) for c in GOOD], SCHEMA).write.parquet(data)
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,a,b\n2,Bronx,a,b\n3,N/A,a,b\n")
    (tmp_path / "weather").mkdir()
    head = "year,month,day,max,min,precipitation1,precipitation2,precipitation3\n"
    (tmp_path / "weather" / "01.csv").write_text(head + "2024,01,31,50,32,T,0.05,0.06\n")
    (tmp_path / "weather" / "02.csv").write_text(head + "2024,02,01,86,40,M,0,0\n")
    out, weather = f"{tmp_path}/out", f"{tmp_path}/weather/*.csv"
    run(spark, "trips", "--trips", data, data, "--zones", zones, "--weather", weather, "--out", out)
    got = values(spark.read.parquet(f"{out}/location_analysis"))
    assert got == [("Queens", "Bronx", 4, 16.67, 20.0, 5.0)]
    assert values(spark.read.parquet(f"{out}/peak_hours")) == [(0, 2), (8, 6)]
    assert spark.read.option("header", True).csv(f"{out}/metrics_csv").count() == 1
    detail = spark.read.parquet(f"{out}/detail")
    assert 0 < detail.count() < 8 and detail.filter("weather_category = 'Unknown'").count() == 0
    assert {"year", "month", "day"} <= set(detail.columns)
    run(spark, "fares", "--trips", data, "--weather", weather, "--year", 2024, "--month", 1, "--out", out)
    assert values(spark.read.parquet(f"{out}/temperatures"), "temp_group", "count") == [(10.0, 5)]
    run(spark, "daily", "--trips", data, "--year", 2024, "--out", out)
    assert spark.read.parquet(f"{out}/daily_metrics").count() == 3


def test_economies(spark, tmp_path):
    head = "<tr><th>a</th></tr><tr><th>b</th></tr><tr><td>World</td><td>9</td></tr>"
    html = f"<table>{head}<tr><td>Egypt</td><td>395,926</td></tr></table>"
    spark.createDataFrame([(1, html)], "page_id int, html string").write.parquet(f"{tmp_path}/pages")
    (tmp_path / "m.csv").write_text("Country,region\nEgypt,Arab\nEgypt,African\n")
    run(spark, "economies", "--pages", f"{tmp_path}/pages", "--membership", tmp_path / "m.csv",
        "--table", "economies_job", "--day", "2024-01-02", "--out", f"{tmp_path}/out")
    means = values(spark.read.parquet(f"{tmp_path}/out/region_means"))
    assert means == [("African", 395.93), ("Arab", 395.93)]


def test_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("b a\nA\n")
    run(spark, "lines", "--job", "words", "--input", tmp_path / "t.txt", "--out", f"{tmp_path}/out")
    assert values(spark.read.text(f"{tmp_path}/out")) == [("a\t2",), ("b\t1",)]


def test_keywords(spark, tmp_path):
    rows = [
        {"id": "1", "sentiment": "Positive", "text": "Bright bright sun, @x #1"},
        {"id": "2", "sentiment": "Positive", "text": "sun and moon"},
        {"id": "3", "sentiment": None, "text": "left out"},
    ]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(r) for r in rows))
    run(spark, "keywords", "--texts", tmp_path / "r.json", "--key", "id", "--label", "sentiment",
        "--top", 2, "--out", f"{tmp_path}/out")
    top = values(spark.read.parquet(f"{tmp_path}/out/keywords"), "sentiment", "term")
    assert top == [("Positive", "bright"), ("Positive", "moon")]
    counts = values(spark.read.parquet(f"{tmp_path}/out/frequencies"), "term", "n")
    assert counts == [("bright", 2), ("moon", 1), ("sun", 2)]


def test_procurement(spark, tmp_path):
    days = "\n".join(f"w,2025-08-{14 + i},{s}" for i, s in enumerate([2, 1, 4, 6, 3, 5, 3]))
    (tmp_path / "s.csv").write_text("scenario,date,supply\n" + days + "\n")
    (tmp_path / "a.csv").write_text("scenario,date,bought\nw,2025-08-17,6\nw,2025-08-19,9\n")
    run(spark, "procurement", "--schedule", tmp_path / "s.csv", "--actuals", tmp_path / "a.csv",
        "--out", f"{tmp_path}/out")
    plan = spark.read.parquet(f"{tmp_path}/out/plan").filter("buy > 0")
    assert values(plan, "date", "buy") == [(date(2025, 8, 17), 6), (date(2025, 8, 19), 4)]
    # Nine of five units is no valid entry.
    compared = spark.read.parquet(f"{tmp_path}/out/comparison").first()
    assert (compared["units"], compared["achieved"]) == (6.0, False)
