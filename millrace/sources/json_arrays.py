"""Large JSON arrays of records, read in as many tasks as the files have splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACE = ("file", "block")


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files cut behind every closing brace: ``file, block, pos, value`` and counts.

    ``block`` is where the split begins, ``pos`` ascends in it.  ``quotes``
    counts the quotes that open or close a string; ``opens0`` and ``opens1``
    the opening braces outside strings if the fragment starts outside of one
    or in one.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    cut = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
        F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"').alias("parts"),
    )

    def opens(odd: int) -> Column:
        return F.aggregate(
            F.transform(
                "parts",
                lambda p, i: F.when(
                    i % 2 == odd, F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit("")))
                ).otherwise(0),
            ),
            F.lit(0),
            lambda total, n: total + n,
        )

    return cut.select(
        *_PLACE,
        "pos",
        "value",
        (F.size("parts") - 1).alias("quotes"),
        opens(0).alias("opens0"),
        opens(1).alias("opens1"),
    )


def _before() -> Window:
    return (
        Window.partitionBy(*_PLACE)
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _upto() -> Window:
    return _before().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _steps(fragments: DataFrame, start: Column, suffix: str = "") -> DataFrame:
    """Adds what a fragment does if its block starts inside a string (1) or not (0).

    ``closes``: its brace ends an object; ``run``: objects that are open after
    it more than at the start of the block.
    """
    inside = (F.col("seen") + start) % 2
    closes = (inside + F.col("quotes")) % 2 == 0
    step = F.when(inside == 0, F.col("opens0")).otherwise(F.col("opens1")) - closes.cast("int")
    out = fragments.withColumns({f"closes{suffix}": closes, f"step{suffix}": step})
    return out.withColumn(f"run{suffix}", F.sum(f"step{suffix}").over(_upto()))


def _states(fragments: DataFrame) -> DataFrame:
    """State in which each block starts: one row per split of a file.

    ``inside``: in a string; ``depth``: open objects; ``owner``: the last block
    before in which a record ends, whose last, open record goes on here.
    """
    seen = fragments.drop("value").withColumn(
        "seen", F.coalesce(F.sum("quotes").over(_before()), F.lit(0))
    )
    both = _steps(_steps(seen, F.lit(0), "0"), F.lit(1), "1")
    blocks = both.groupBy(*_PLACE).agg(
        F.sum("quotes").alias("quotes"),
        *[F.sum(f"step{s}").alias(f"step{s}") for s in "01"],
        *[F.min(F.when(F.col(f"closes{s}"), F.col(f"run{s}"))).alias(f"low{s}") for s in "01"],
    )
    # The blocks of one file in order: as many rows as the file has splits.
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    known = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    own = [F.when(F.col("inside") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("step", "low")]
    known = known.select(*_PLACE, "inside", own[0].alias("step"), own[1].alias("low"))
    known = known.withColumn("depth", F.coalesce(F.sum("step").over(earlier), F.lit(0)))
    # Where all objects are closed a record ends, and depth is never below.
    ends = F.when(F.col("depth") + F.col("low") <= 0, F.col("block"))
    return known.select(
        *_PLACE, "inside", "depth", F.last(ends, ignorenulls=True).over(earlier).alias("owner")
    )


def record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``: the JSON text of each object in the arrays of some files.

    Files are split as text files are.  A small scan of quotes and braces finds
    the string and depth state in which each split starts; with it a split
    finds the ends of its records by itself, and only the record that crosses
    its border is put together from two or more splits.  Braces, quotes and
    escapes in strings and nested objects are no borders.  What is between the
    objects (brackets, commas, blanks) is dropped, so files of several arrays
    and of JSON lines can be read too.  Elements that are no objects are
    dropped.  Empty files and arrays give no rows.
    """
    fragments = _fragments(spark, path)
    # Quotes of the block so far; the window serves all steps that follow.
    main = fragments.join(_states(fragments), list(_PLACE)).withColumn(
        "seen", F.coalesce(F.sum("quotes").over(_before()), F.lit(0))
    )
    main = _steps(main, F.col("inside")).withColumn(
        "ends", (F.col("closes") & (F.col("depth") + F.col("run") == 0)).cast("int")
    )
    whole = _before().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    main = main.withColumns(
        {
            "done": F.coalesce(F.sum("ends").over(_before()), F.lit(0)),
            "all": F.sum("ends").over(whole),
        }
    )
    none = F.lit(-1).cast("bigint")
    first, rest = F.col("done") == 0, F.col("done") == F.col("all")
    keyed = main.select(
        "file",
        F.when(first, F.coalesce("owner", none)).otherwise(F.col("block")).alias("home"),
        F.when(first | rest, none).otherwise(F.col("done")).alias("number"),
        F.struct("block", "pos", "value").alias("part"),
    )
    parts = F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"])
    joined = keyed.groupBy("file", "home", "number").agg(F.array_join(parts, "}").alias("text"))
    text = F.concat(F.regexp_replace("text", "^[^{]+", ""), F.lit("}"))
    return joined.select(text.alias("value")).filter(F.col("value").startswith("{"))


def read_record_arrays(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str
) -> DataFrame:
    """Records of JSON arrays under a schema; fields that a record lacks are null."""
    record = F.from_json("value", schema)
    return record_texts(spark, path).select(record.alias("record")).select("record.*")
