"""Lempel-Ziv phrase fingerprints of documents and their neighbours."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shingles import mix
from millrace.llm.shipping import ship
from millrace.storage import materialize

SEED = 4
SIZE = 64
_CHUNK = 1 << 14
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_rng = np.random.default_rng(SEED)
_A = _rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, SIZE, dtype=np.uint64)


def parse(text: str, start: int, limit: int, seen: set[str]) -> list[int]:
    """Ends of the phrases that begin at ``start`` and end by ``limit``.

    A phrase is the shortest piece that is not in the dictionary ``seen``, to
    which it is added.  All prefixes of a phrase are phrases, so the search
    may begin at the length of the last one and move either way.
    """
    ends: list[int] = []
    add, append = seen.add, ends.append
    length = 1
    while start < limit:
        end = start + length
        if end > limit:
            end = limit
        piece = text[start:end]
        if piece in seen:
            while piece in seen and end < limit:
                end += 1
                piece = text[start:end]
            if piece in seen:
                break  # the rest is a known phrase, or its end depends on what follows
        else:
            while end - start > 1:
                shorter = text[start : end - 1]
                if shorter in seen:
                    break
                piece = shorter
                end -= 1
        add(piece)
        append(end)
        length = end - start
        start = end
    return ends


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        tables = []
        for base in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            table = np.full(max(n, _CHUNK), base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _POWERS[:] = tables
    return _POWERS[0][:n], _POWERS[1][:n]


def phrase_hashes(text: str, start: int, ends: list[int]) -> np.ndarray:
    """64-bit hashes of consecutive phrases, equal for equal phrases anywhere."""
    if not ends:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(text[start : ends[-1]].encode("utf-32-le"), np.uint32)
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) * _STEP + _STEP) * up[:-1], out=sums[1:])
    bounds = np.array([start, *ends]) - start
    return mix((sums[bounds[1:]] - sums[bounds[:-1]]) * down[bounds[:-1]])


def minima(hashes: np.ndarray) -> np.ndarray:
    """Smallest value of the hashes under each of the fixed permutations."""
    least = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK, None] * _A + _B
        least = np.minimum(least, part.min(axis=0))
    return least


def signature(least: np.ndarray) -> str:
    """Four hex digits for each permutation's minimum."""
    return (mix(least) >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal minima; 1 for two empty fingerprints, 0 for one."""
    if not a or not b:
        return float(a == b)
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / SIZE


@dataclass
class Parsed:
    """A text's fingerprint, and how far it goes with its edited text."""

    text: str
    kept: int
    fingerprint: str
    rest: int
    seen: set[str]
    least: np.ndarray

    @classmethod
    def of(cls, text: str) -> Parsed:
        kept = len(text) - len(text) // 2
        seen: set[str] = set()
        ends = parse(text, 0, kept, seen)
        least = minima(phrase_hashes(text, 0, ends))
        rest = ends[-1] if ends else 0
        known = set(seen)
        more = parse(text, rest, len(text), known)
        whole = np.minimum(least, minima(phrase_hashes(text, rest, more)))
        return cls(text, kept, signature(whole) if text else "", rest, seen, least)

    def edited(self, following: str) -> tuple[str, str]:
        """The text with its last half replaced by the next one's head, and its fingerprint.

        Phrases inside the kept part are those of the text, so only the rest
        is parsed anew.  Uses up the dictionary.
        """
        text = self.text[: self.kept] + following[: len(self.text) - self.kept]
        ends = parse(text, self.rest, len(text), self.seen)
        least = np.minimum(self.least, minima(phrase_hashes(text, self.rest, ends)))
        return text, signature(least) if text else ""


def _bucket(doc_id: Column, splits: list[int]) -> Column:
    """How many splits are at most the id, by a coarse and a fine step."""
    if not splits:
        return F.lit(0)
    step = math.isqrt(len(splits)) + 1

    def at_most(table: Column) -> Column:
        return F.size(F.filter(table, lambda s: s <= doc_id))

    def constant(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    coarse = at_most(constant(splits[::step]))
    start = F.greatest(coarse - 1, F.lit(0)) * step
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(
        start + at_most(F.slice(constant(splits), start + 1, F.lit(step)))
    )


_OUT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket and id; the last of a bucket is the next bucket's first."""
    bucket, pending, pending_id, rows = None, None, None, []
    for batch in batches:
        for b, halo, doc_id, text in zip(*(c.to_pylist() for c in batch.columns[:4])):
            parsed = Parsed.of(text or "")
            if b == bucket:
                edited, fingerprint = pending.edited(parsed.text)
                rows.append(
                    (
                        pending_id,
                        len(pending.text),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        pending.fingerprint,
                        fingerprint,
                        likeness(pending.fingerprint, fingerprint),
                        likeness(pending.fingerprint, parsed.fingerprint),
                    )
                )
            bucket, pending, pending_id = (None, None, None) if halo else (b, parsed, doc_id)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows)],
                ["doc_id"] + [f.split()[0] for f in _OUT.split(",")],
            )
            rows = []


def fingerprint_documents(
    docs: DataFrame, *, doc_id="doc_id", text="text", rows_per_bucket: int = 2_000
) -> DataFrame:
    """Phrase fingerprints of each text and of the text edited with its successor.

    Documents follow each other by descending id, then descending digest of
    the text, nulls last; after the last comes the first.  Returns ``doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, one row per row of ``docs``.  Null text: as empty; the
    fingerprint of an empty text is empty, like only another empty one.  Equal
    texts have equal fingerprints.  A single document follows itself.  Empty
    table: empty result.  Other columns are ignored.  Ids are whole numbers.

    The texts are shuffled once, by quantile of the id; the first row of each
    bucket also goes to the bucket before it, so no task waits for another.
    """
    spark = docs.sparkSession
    ship(spark)
    keyed = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")
    )
    n = docs.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-n // rows_per_bucket), 4 * partitions))
    quantiles = [k / parts for k in range(1, parts)]
    found = keyed.agg(
        F.percentile_approx("doc_id", quantiles or [0.5], 20 * parts + 1000)
    ).first()[0]
    splits = sorted(set(found or [])) if quantiles else []
    placed = keyed.withColumn("bucket", _bucket(F.col("doc_id"), splits))
    # One row per bucket; written, so that its size is known to the planner.
    first = (
        placed.groupBy("bucket")
        .agg(F.max(F.struct("doc_id", F.md5("text").alias("digest"))).alias("head"))
        .select("bucket", "head")
    )
    around = Window.orderBy(F.desc("bucket"))
    before = F.coalesce(
        F.lag("bucket").over(around), F.min("bucket").over(Window.partitionBy())
    )
    heads = materialize(
        first.select(
            F.col("bucket").alias("of"), "head", before.cast("int").alias("to")
        ),
        "phrase-heads",
    )
    same = (
        (F.col("bucket") == F.col("of"))
        & F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
        & F.md5("text").eqNullSafe(F.col("head.digest"))
    )
    halo = placed.join(heads, same).select("to", "text").dropDuplicates(["to"])
    order = placed.select(
        F.col("bucket").cast("int"), F.lit(0).alias("halo"), "doc_id", "text"
    ).unionByName(
        halo.select(
            F.col("to").alias("bucket"),
            F.lit(1).alias("halo"),
            F.lit(None).cast("bigint").alias("doc_id"),
            "text",
        )
    )
    ordered = order.repartition(partitions, "bucket").sortWithinPartitions(
        "bucket", "halo", F.desc_nulls_last("doc_id"), F.md5("text").desc_nulls_last()
    )
    return ordered.mapInArrow(_fingerprints, f"doc_id long, {_OUT}")
