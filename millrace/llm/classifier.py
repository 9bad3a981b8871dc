"""Quality classifier: random Fourier features, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shipping import ship
from millrace.llm.texts import fraction
from millrace.storage import materialize

SEED = 6
ACCEPT = 0.7

_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]\\^~_=+", np.uint8)
_ENDS = np.frombuffer(b".,;:?", np.uint8)
_BINS = 4096
# Sums of training rows meet in this many tasks, whatever the corpus' size.
_SUM_TASKS = 8


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text, all of the order of 1; null counts as empty."""
    text = text or ""
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size, n = max(1, raw.sum()), max(1, len(words))
    pairs = max(1, len(words) - 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    return [
        np.log1p(len(words)),
        np.log1p(len(words) / max(1, len(lines))),
        lengths.mean() / 5,
        lengths.std() / 3,
        raw[65:91].sum() / size * 5,
        raw[48:58].sum() / size * 10,
        raw[_SYMBOLS].sum() / size * 10,
        raw[33] / size * 20,
        raw[_ENDS].sum() / size * 10,
        raw[128:].sum() / size * 3,
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / pairs,
        max(Counter(words).values(), default=0) / n * 3,
        sum(map(eq, words, words[1:])) / pairs * 3,
        len(set(lines)) / max(1, len(lines)),
        (lengths <= 3).sum() / n,
    ]


_N = len(statistics(""))


@dataclass
class QualityModel:
    """A fitted scorer; a few thousand numbers, whatever it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw_at: np.ndarray
    score_at: np.ndarray

    def lift(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features of the standardised statistics, and a constant."""
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        cosines = np.cos(z @ self.directions + self.phases)
        return np.hstack([cosines * np.sqrt(2 / len(self.phases)), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores in [0, 1]; a slight slope keeps the order inside a flat step."""
        raw = self.raw(stats)
        steps = np.interp(raw, self.raw_at, self.score_at)
        return np.clip(0.999 * steps + 0.001 * np.clip(raw, 0, 1), 0, 1)


def _constant(value: float) -> QualityModel:
    zeros = np.zeros(1)
    return QualityModel(
        np.zeros(_N), np.ones(_N), np.zeros((_N, 1)), zeros, np.array([0, value]),
        np.array([value]), np.array([value]),
    )


def isotonic(raw: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted bins: places and non-decreasing means."""
    blocks: list[list[float]] = []
    for x, g, k in zip(raw, good, n):
        blocks.append([x * k, g, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            x_sum, g_sum, k_sum = blocks.pop()
            blocks[-1] = [blocks[-1][0] + x_sum, blocks[-1][1] + g_sum, blocks[-1][2] + k_sum]
    at = np.array([x / k for x, _, k in blocks])
    # A small prior keeps a pure block of a few rows away from 0 and 1.
    return at, np.array([(g + 0.5) / (k + 1) for _, g, k in blocks])


def describe(docs: DataFrame, *, doc_id="doc_id", text="text") -> DataFrame:
    """``doc_id, stats``: the statistics of each whole text, one row per row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"]
            )

    ship(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(rows, f"doc_id {kind}, stats array<double>")


def fold(doc_id: Column) -> Column:
    """Remainder of the id's checksum by 4; remainder 2 is held out of training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _stack(frame: pd.DataFrame) -> np.ndarray:
    return np.vstack(frame["stats"].to_numpy()) if len(frame) else np.zeros((0, _N))


def fit(
    described: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    features: int = 256,
    width: float = 3.0,
    ridge: float = 1e-3,
    most_rows: int = 200_000,
    seed: int = SEED,
) -> QualityModel:
    """Fit on at most about ``most_rows`` labelled rows outside the held-out fold.

    Labels count if they are 0 or 1; a doc_id labelled in several rows counts
    by its lowest label.  If there are more rows, a hash of the id samples
    them.  Folds 0 and 1 give the ridge weights (normal equations summed per
    partition), fold 3 the calibration, or all three if it lacks a class.
    Without both labels the score is constant: the only label seen, or 1.
    """
    ship(described.sparkSession)
    marks = (
        labels.filter(F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("marked"))
        .agg(F.min(label).alias("label"))
        .filter(fold(F.col("marked")) != 2)
    )
    n_marks = marks.count()
    share = min(1.0, most_rows / max(1, n_marks))
    sample = marks.filter(fraction(seed, F.col("marked")) < share)
    rows = materialize(
        described.join(sample, F.col("doc_id") == F.col("marked"))
        .select("stats", "label", fold(F.col("doc_id")).alias("fold"))
        .repartition(_SUM_TASKS),
        "quality-rows",
    )
    moments = rows.select("label", *[F.get("stats", F.lit(i)).alias(f"s{i}") for i in range(_N)])
    summary = moments.agg(
        F.count("*"),
        F.sum("label"),
        *[F.avg(f"s{i}") for i in range(_N)],
        *[F.stddev_pop(f"s{i}") for i in range(_N)],
    ).first()
    n, good = summary[0], summary[1] or 0
    if not 0 < good < n:
        return _constant(float(good == n))
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean=np.array(summary[2 : 2 + _N], float),
        scale=np.maximum(np.array(summary[2 + _N :], float), 1e-3),
        directions=rng.normal(size=(_N, features)) / width,
        phases=rng.uniform(0, 2 * np.pi, features),
        weights=np.zeros(features + 1),
        raw_at=np.zeros(1),
        score_at=np.zeros(1),
    )

    def equations(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for frame in frames:
            x = model.lift(_stack(frame))
            left += x.T @ x
            right += x.T @ frame["label"].to_numpy(float)
        yield pd.DataFrame({"left": [left.tobytes()], "right": [right.tobytes()]})

    def solved(part: DataFrame) -> np.ndarray:
        left, right = ridge * n * np.eye(features + 1), np.zeros(features + 1)
        left[-1, -1] = 1e-9
        sums = part.mapInPandas(equations, "left binary, right binary")
        for row in sums.toLocalIterator():  # one row per sum task
            left += np.frombuffer(row[0]).reshape(left.shape)
            right += np.frombuffer(row[1])
        return np.linalg.solve(left, right)

    def histogram(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = np.clip(model.raw(_stack(frame)), -0.5, 1.5)
            bins = np.minimum(((raw + 0.5) / 2 * _BINS).astype(int), _BINS - 1)
            yield pd.DataFrame({"bin": bins, "label": frame["label"], "raw": raw})

    model.weights = solved(rows.filter("fold <> 3"))
    checked = rows.filter("fold = 3")
    seen = checked.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    bins = (
        (checked if 0 < seen[1] < seen[0] else rows)
        .mapInPandas(histogram, "bin int, label int, raw double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("good"), F.avg("raw").alias("raw"))
        .orderBy("bin")
        .toPandas()  # at most _BINS rows
    )
    model.raw_at, model.score_at = isotonic(
        bins["raw"].to_numpy(), bins["good"].to_numpy(float), bins["n"].to_numpy(float)
    )
    return model


def score(described: DataFrame, model: QualityModel, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each described row.

    Null and empty texts are described like any text and so have a score; a
    null doc_id is in no fold.  Empty table: empty result.
    """

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["doc_id"]].assign(score=model.score(_stack(frame)))

    ship(described.sparkSession)
    # Whole numbers with nulls would turn into floats in pandas: text is safe.
    kind = described.schema["doc_id"].dataType
    named = described.select(F.col("doc_id").cast("string").alias("doc_id"), "stats")
    out = named.mapInPandas(scored, "doc_id string, score double")
    return out.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= accept).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, model: QualityModel, *, text="text", accept: float = ACCEPT
) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns; no shuffle."""
    ship(docs.sparkSession)
    place = docs.columns.index(text)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                stats = np.array([statistics(t) for t in batch.column(place).to_pylist()])
                yield batch.filter(pa.array(model.score(stats) >= accept))

    return docs.mapInArrow(accepted, docs.schema)
