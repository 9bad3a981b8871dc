"""The analyses as batch jobs over files: ``spark-submit millrace/jobs.py <job>``.

Results that are small by construction (one row per category or day) are
written as one file, everything else keeps its partitions.
"""

from __future__ import annotations

import argparse
import dataclasses
import os
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.operators.planning import Terms
from millrace.plans import economies, fares, keywords, procurement, trips
from millrace.session import configure
from millrace.sources import readers, sinks
from millrace.storage import materialize, scope
from millrace.streaming import line_jobs

# Columns of the public files, and the default purchase.
TARGET, BASE_PRICE = 10, 1500.0
ZONE_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]
WEATHER_COLUMNS = [
    "year", "month", "day", "max", "min", "precipitation1", "precipitation2", "precipitation3",
]
LINE_JOBS = {
    "words": line_jobs.word_count,
    "raw-words": line_jobs.word_count_raw,
    "labels": line_jobs.label_count,
    "rating-means": line_jobs.rating_mean,
    "rating-counts": line_jobs.rating_count_mean,
}


def _result(df: DataFrame, out: str, name: str, small: bool = True) -> None:
    """Parquet, and CSV converted from it: the result is computed once."""
    sinks.write_parquet(df, f"{out}/{name}", small=small)
    written = df.sparkSession.read.schema(df.schema).parquet(f"{out}/{name}")
    sinks.write_csv(written.coalesce(1) if small else written, f"{out}/{name}_csv")


def _weather(spark: SparkSession, args) -> DataFrame:
    raw = readers.read_csv(spark, args.weather, readers.all_text(WEATHER_COLUMNS))
    return trips.daily_weather(raw)


def _trips(spark: SparkSession, args) -> DataFrame:
    rows = readers.read_parts(spark, args.trips)
    return rows if args.sample is None else rows.sample(False, args.sample, seed=42)


def run_trips(spark: SparkSession, args) -> None:
    """Five result tables and the joined detail."""
    rows = _trips(spark, args)
    columns = readers.all_text(ZONE_COLUMNS[: args.zone_columns])
    zones = readers.read_csv(spark, args.zones, columns)
    # Joined once.  The peak hours count days without weather too, the detail does not.
    joined = materialize(trips.detail(rows, zones, _weather(spark, args)), "trips-joined")
    sinks.write_parquet(trips.known_weather(joined), f"{args.out}/detail")
    _result(trips.global_means(rows), args.out, "metrics")
    for name, df in trips.reports_from(joined).items():
        _result(df, args.out, name)


def run_fares(spark: SparkSession, args) -> None:
    """Fares of one month by kind of day and by temperature."""
    month = fares.month_fares(_trips(spark, args), args.year, args.month)
    _result(fares.by_day_type(month), args.out, "day_types")
    _result(fares.by_temperature(month, _weather(spark, args)), args.out, "temperatures")


def run_daily(spark: SparkSession, args) -> None:
    """Revenue summary and daily figures of one year."""
    rows = _trips(spark, args)
    _result(fares.revenue_summary(rows, args.year), args.out, "summary")
    _result(fares.daily_metrics(rows, args.year), args.out, "daily_metrics")


def run_economies(spark: SparkSession, args) -> None:
    """Country figures from stored pages, archived and loaded as a table."""
    pages = spark.read.parquet(args.pages)
    member = readers.read_csv(spark, args.membership, "Country string, region string")
    table = economies.transform(economies.extract(pages), member)
    economies.load(economies.largest_first(table), args.out, args.table, date.fromisoformat(args.day))
    loaded = spark.table(args.table)
    _result(economies.over(loaded), args.out, "over_100", small=False)
    _result(economies.region_means(loaded), args.out, "region_means")


def run_lines(spark: SparkSession, args) -> None:
    """One of the line jobs, as tab-separated text."""
    sinks.write_csv(
        LINE_JOBS[args.job](readers.read_lines(spark, args.input)), args.out, header=False, sep="\t"
    )


def run_keywords(spark: SparkSession, args) -> None:
    """Term frequencies and TF-IDF keywords per class of JSON-lines texts."""
    key, cls = args.key, args.label
    docs = readers.read_json_lines(spark, args.texts, f"`{key}` string, `{cls}` string, text string")
    docs = docs.dropna(subset=["text", cls])
    sinks.write_parquet(keywords.term_frequencies(docs, "text", [cls]), f"{args.out}/frequencies")
    extra: list[str] = []
    if args.stop_words:  # a list that a person wrote
        lines = readers.read_lines(spark, args.stop_words).select(F.lower(F.trim("value")))
        extra = [row[0] for row in lines.collect() if row[0]]
    top = keywords.keywords(docs, key, "text", [cls], args.vocabulary, args.top, extra)
    sinks.write_parquet(top, f"{args.out}/keywords")


def run_procurement(spark: SparkSession, args) -> None:
    """Plan per scenario and, with purchases, the comparison and the re-plans."""
    columns = "scenario string, date string, supply bigint" + ", noise double" * args.noise
    read = readers.read_json_array if args.schedule.endswith(".json") else readers.read_csv
    days = read(spark, args.schedule, columns)
    terms = Terms(**{f.name: getattr(args, f.name) for f in dataclasses.fields(Terms)})
    schedule = procurement.schedule_from(
        days, args.target, args.base_price, "noise" if args.noise else None
    )
    schedule = materialize(schedule, "schedule")  # the plan and the re-plans look at it
    plan = procurement.baseline(schedule, terms)
    sinks.write_parquet(plan, f"{args.out}/plan")
    sinks.write_parquet(procurement.plan_summary(plan), f"{args.out}/plan_summary")
    if args.actuals:
        entered = readers.read_csv(
            spark, args.actuals, "scenario string, date date, bought bigint"
        )
        numbered = schedule.select("scenario", "date", "idx")
        bought = entered.join(numbered, ["scenario", "date"]).select("scenario", "idx", "bought")
        history = procurement.actual_history(schedule, bought, terms)
        sinks.write_parquet(history, f"{args.out}/history")
        sinks.write_parquet(procurement.compare(schedule, bought, terms), f"{args.out}/comparison")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    jobs = top.add_subparsers(dest="name", required=True)

    def job(name, run, *required):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for option in (*required, "out"):
            sub.add_argument(f"--{option}", required=True)
        return sub

    def trip_input(sub):
        sub.add_argument("--trips", nargs="+", required=True)
        sub.add_argument("--sample", type=float)

    sub = job("trips", run_trips, "zones", "weather")
    trip_input(sub)
    sub.add_argument("--zone-columns", type=int, default=len(ZONE_COLUMNS))
    sub = job("fares", run_fares, "weather")
    trip_input(sub)
    sub.add_argument("--year", type=int, required=True)
    sub.add_argument("--month", type=int, required=True)
    sub = job("daily", run_daily)
    trip_input(sub)
    sub.add_argument("--year", type=int, required=True)
    sub = job("economies", run_economies, "pages", "membership", "table")
    sub.add_argument("--day", default=date.today().isoformat())
    sub = job("lines", run_lines, "input")
    sub.add_argument("--job", choices=sorted(LINE_JOBS), required=True)
    sub = job("keywords", run_keywords, "texts", "key", "label")
    sub.add_argument("--vocabulary", type=int, default=1000)
    sub.add_argument("--stop-words", help="file with further stop words, one per line")
    sub.add_argument("--top", type=int, default=200)
    sub = job("procurement", run_procurement, "schedule")
    sub.add_argument("--actuals")
    sub.add_argument("--noise", action="store_true", help="the schedule has price deviations")
    sub.add_argument("--target", type=int, default=TARGET)
    sub.add_argument("--base-price", type=float, default=BASE_PRICE)
    for field in dataclasses.fields(Terms):
        option = "--" + field.name.replace("_", "-")
        sub.add_argument(option, type=float, default=field.default)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName(f"millrace-{args.name}").getOrCreate())
    # Results are written by the job, so what it wrote on the way can go.
    with scope(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
