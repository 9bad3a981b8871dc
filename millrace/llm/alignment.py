"""Alignment of two tokenizers over a corpus, each distinct text handled once."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pieces import MARK
from millrace.llm.shipping import ship
from millrace.llm.token_counts import PATTERN, MergeTable, byte_alphabet
from millrace.storage import materialize

# Characters of texts that are encoded and aligned at a time.
_SLICE_CHARS = 250_000
# So many of the most counted id pairs are known to every task (16 bytes each);
# texts that link other pairs ask for those by a join, so any number is exact.
MOST_KNOWN = 1 << 18
# Texts with more than this share of all rows are at most as many; they are
# joined apart from the others.
_HEAVY = 1_000
# Links of one group that are listed before equal pairs are counted.
_MOST_LISTED = 1 << 16

_LONG_RUN = re.compile(r"(?<!\S)\S{1000}|(?<!\s)\s{1000}")

_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


@dataclass
class Model:
    """Content of a vocabulary file, small and fixed, and the bytes of its tokens."""

    kind: str
    content: bytes
    token_bytes: list[bytes]
    # Characters that the two byte-level encoders may split differently.
    unknown: frozenset[str] = frozenset()
    # Ids ascend as the merges do, so that they are ranks.
    ranked: bool = False

    @classmethod
    def load(cls, path: str) -> Model:
        """Read on the driver: a byte-level ``.json`` or a piece ``.model``."""
        with open(path, "rb") as file:
            content = file.read()
        kind = os.path.splitext(path)[1]
        unknown, ranked = frozenset(), False
        if kind == ".json":
            from tokenizers import Tokenizer

            merges = MergeTable.load(path)
            unknown = merges.unknown
            ranked = bool(
                (np.diff(merges.merged) > 0).all() and merges.byte_ids.max() < merges.merged.min()
            )
            coder = Tokenizer.from_str(content.decode())
            value = {c: b for b, c in enumerate(byte_alphabet())}
            tokens = map(coder.id_to_token, range(coder.get_vocab_size()))
            table = [bytes(map(value.__getitem__, t)) if t else b"" for t in tokens]
            special = coder.get_added_tokens_decoder()
            for i in special:
                table[i] = b""
        elif kind == ".model":
            import sentencepiece

            coder = sentencepiece.SentencePieceProcessor(model_proto=content)
            table = []
            for i in range(coder.get_piece_size()):
                piece = coder.id_to_piece(i)
                if coder.is_byte(i):
                    table.append(bytes([int(piece[3:5], 16)]))
                elif coder.is_control(i) or coder.is_unknown(i):
                    table.append(b"")
                else:
                    table.append(piece.replace(MARK, " ").encode())
        else:
            raise ValueError(f"unknown kind of vocabulary file: {path}")
        return cls(kind, content, table, unknown, ranked)

    def encoder(self):
        """Function from texts to id lists; special strings are plain text.

        A byte-level vocabulary gets a space before each text, a piece
        vocabulary adds its own.
        """
        if self.kind == ".json":
            return _ByteEncoder(self)
        import sentencepiece

        piece = sentencepiece.SentencePieceProcessor(model_proto=self.content)
        return lambda texts: piece.encode(texts, num_threads=1)


class _ByteEncoder:
    """Ids of a byte-level vocabulary for texts with a space in front.

    The vocabulary's own library is slow on words it has not seen, so texts are
    encoded by ranks, which gives the same ids; the library gets those with
    characters only one of the two knows as a letter or number, and with runs
    that are too long for merging by ranks.
    """

    def __init__(self, model: Model):
        self.model = model
        self.library = None
        self.by_rank = None
        if model.ranked:
            import tiktoken

            self.by_rank = tiktoken.Encoding(
                "ranks",
                pat_str=PATTERN,
                mergeable_ranks={t: i for i, t in enumerate(model.token_bytes) if t},
                special_tokens={},
            ).encode_ordinary

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.library = Tokenizer.from_str(self.model.content.decode())
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def __call__(self, texts: list[str]) -> list[list[int]]:
        odd = not self.model.unknown.isdisjoint(set().union(*texts))
        return [
            self._by_library(" " + t)
            if self.by_rank is None
            or _LONG_RUN.search(t)
            or (odd and not self.model.unknown.isdisjoint(t))
            else self.by_rank(" " + t)
            for t in texts
        ]


class Aligner:
    """Aligns the two encodings of texts at the byte offsets where both end a token."""

    def __init__(self, a: Model, b: Model):
        self.bytes = (a.token_bytes, b.token_bytes)
        self.encode = (a.encoder(), b.encoder())
        self.size = tuple(np.array([len(t) for t in m], np.int64) for m in self.bytes)
        # Texts of each id with the mark that follows it: inside its side of a
        # group, and at the end of the side.
        self.shift = np.cumsum([0] + [len(m) for m in self.bytes for _ in range(2)])
        self.texts = [
            f"{i}{mark}"
            for m, marks in zip(self.bytes, (",|", ",;"))
            for mark in marks
            for i in range(len(m))
        ]

    def encodings(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where either does not give the text back."""
        found = [encode(texts) for encode in self.encode]
        for i, text in enumerate(texts):
            whole = (" " + text).encode()
            if not text or any(
                b"".join(map(table.__getitem__, ids[i])) != whole
                for table, ids in zip(self.bytes, found)
            ):
                found[0][i] = found[1][i] = []
        return found[0], found[1]

    def align(self, texts: list[str]) -> dict[str, Any]:
        """Per text ``n_a, n_b, n_groups, n_links``, the digest of the groups, and
        its distinct linked pairs (``a << 32 | b``) with their number of links."""
        n = len(texts)
        sides = self.encodings(texts)
        many = [np.array([len(x) for x in side], np.int64) for side in sides]
        ids = [np.fromiter(itertools.chain.from_iterable(s), np.int64, m.sum()) for s, m in zip(sides, many)]
        # Both sides of all texts in a row: the ends of texts are common ends.
        ends = [np.cumsum(size[x]) for size, x in zip(self.size, ids)]
        common = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(common, e) for e in ends]
        owner = np.repeat(np.arange(n), many[0])[np.searchsorted(ends[0], common)]
        counts = [np.bincount(g, minlength=len(common)) for g in group]
        links = counts[0] * counts[1]
        out = {
            "n_a": many[0],
            "n_b": many[1],
            "n_groups": np.bincount(owner, minlength=n),
            "n_links": np.bincount(owner, links, minlength=n).astype(np.int64),
            "groups_sha256": self._digests(ids, group, counts, many),
        }
        text, pair, times = self._pairs(ids, counts, links, owner)
        out["bounds"] = np.searchsorted(text, np.arange(n + 1))
        out["pairs"], out["times"] = pair, times
        return out

    def _digests(self, ids, group, counts, many) -> list[str]:
        closes = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in group]
        codes = np.concatenate(
            [x + self.shift[2 * k + c.astype(int)] for k, (x, c) in enumerate(zip(ids, closes))]
        )
        # The A tokens of a group, then its B tokens.
        before = [np.cumsum(c) - c for c in counts]
        place = np.concatenate(
            [
                np.arange(len(ids[0])) + before[1][group[0]],
                np.arange(len(ids[1])) + (before[0] + counts[0])[group[1]],
            ]
        )
        ordered = np.empty(len(codes), np.int64)
        ordered[place] = codes
        marks = list(map(self.texts.__getitem__, ordered.tolist()))
        stops = np.cumsum(many[0] + many[1]).tolist()
        return [
            hashlib.sha256("".join(marks[i:j])[:-1].encode()).hexdigest() if j > i else ""
            for i, j in zip([0, *stops], stops)
        ]

    def _pairs(self, ids, counts, links, owner):
        """Text, pair and number of links of each distinct pair of a text, in order."""
        first = [np.cumsum(c) - c for c in counts]
        parts = []
        large = links > _MOST_LISTED
        some = np.flatnonzero(~large)
        total = links[some]
        at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        wide = np.repeat(counts[1][some], total)
        a = ids[0][np.repeat(first[0][some], total) + at // wide]
        b = ids[1][np.repeat(first[1][some], total) + at % wide]
        parts.append((np.repeat(owner[some], total), a << 32 | b, np.ones(len(a), np.int64)))
        for g in np.flatnonzero(large):
            # Equal ids of a large group are counted before they are paired.
            (x, nx), (y, ny) = (
                np.unique(ids[k][first[k][g] : first[k][g] + counts[k][g]], return_counts=True)
                for k in (0, 1)
            )
            pair = (x[:, None] << 32 | y).ravel()
            parts.append((np.full(len(pair), owner[g]), pair, np.outer(nx, ny).ravel()))
        text, pair, times = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((pair, text))
        text, pair, times = text[order], pair[order], times[order]
        new = np.flatnonzero(
            np.append(True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))[: len(text)]
        )
        return text[new], pair[new], np.add.reduceat(times, new) if len(new) else times


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, length in enumerate(lengths):
        if size and size + length > _SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


def align_texts(texts: DataFrame, a: Model, b: Model) -> DataFrame:
    """``texts`` (``text, copies``) as one written row of measures and pairs each."""
    ship(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast((a, b))
    names = ("tid", "digest", "copies", *_MEASURES, "groups_sha256", "pairs", "times")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            lengths = [len(t) for t in batch.column(0).to_pylist()]
            for low, high in _slices(lengths):
                part = batch.slice(low, high - low)
                found = aligner.align(part.column(0).to_pylist())
                bounds = pa.array(found["bounds"].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + high - low)),
                        part.column(1),
                        part.column(2),
                        *[pa.array(found[m]) for m in _MEASURES],
                        pa.array(found["groups_sha256"], pa.string()),
                        pa.ListArray.from_arrays(bounds, pa.array(found["pairs"])),
                        pa.ListArray.from_arrays(bounds, pa.array(found["times"])),
                    ],
                    names,
                )
                number += high - low

    keyed = texts.select("text", F.sha2("text", 256).alias("digest"), "copies")
    schema = (
        "tid long, digest string, copies long, n_a long, n_b long, n_groups long, n_links long,"
        " groups_sha256 string, pairs array<long>, times array<long>"
    )
    return materialize(keyed.mapInArrow(rows, schema), "aligned-texts")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best`` of the corpus: documents that hold the pair linked, and
    whether no other pair of the same A id has more.  Written.

    The highest counts are at most one row per A id, whatever the corpus.
    """
    counted = materialize(
        aligned.select("copies", F.explode("pairs").alias("pair"))
        .groupBy("pair")
        .agg(F.sum("copies").alias("count")),
        "pair-counts",
    )
    by_a = F.shiftright("pair", 32)
    most = counted.groupBy(by_a.alias("a")).agg(F.max("count").alias("most"))
    return counted.join(F.broadcast(most), by_a == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )


def _known_pairs(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of the highest counts, at most ``MOST_KNOWN``, sorted by pair."""
    level = F.floor(F.log2("count")).cast("int")
    levels = dict(counts.groupBy(level.alias("level")).count().collect())  # at most 64 rows
    least, total = 64, 0
    for at in sorted(levels, reverse=True):
        total += levels[at]
        if total > MOST_KNOWN:
            break
        least = at
    known = counts.filter(level >= least).toArrow()
    pair = known["pair"].to_numpy()
    order = np.argsort(pair)
    return (
        pair[order],
        known["count"].to_numpy()[order],
        known["best"].to_numpy(zero_copy_only=False)[order],
    )


def _measured(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` instead of the pairs.

    Links of known pairs are summed inside the rows; only the other pairs,
    each with few documents, are shuffled to their counts.
    """
    shared = aligned.sparkSession.sparkContext.broadcast(_known_pairs(counts))
    kept = ["tid", "digest", "copies", *_MEASURES, "groups_sha256"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = shared.value
        for batch in batches:
            pairs, times = batch.column(len(kept)), batch.column(len(kept) + 1)
            owner = np.repeat(np.arange(len(batch)), np.diff(pairs.offsets.to_numpy()))
            pairs = pairs.flatten().to_numpy(zero_copy_only=False)
            times = times.flatten().to_numpy(zero_copy_only=False)
            spot = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            hit = pair[spot] == pairs if len(pair) else np.zeros(len(pairs), bool)
            sums = np.zeros((2, len(batch)), np.int64)
            np.add.at(sums[0], owner[hit], times[hit] * best[spot[hit]])
            np.add.at(sums[1], owner[hit], times[hit] * count[spot[hit]])
            bounds = pa.array(
                np.searchsorted(owner[~hit], np.arange(len(batch) + 1)).astype(np.int32)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    *[pa.array(s) for s in sums],
                    pa.ListArray.from_arrays(bounds, pa.array(pairs[~hit])),
                    pa.ListArray.from_arrays(bounds, pa.array(times[~hit])),
                ],
                [*kept, "n_best", "count_sum", "pairs", "times"],
            )

    slim = aligned.select(*kept, "pairs", "times")
    schema = slim.select(
        *kept,
        F.lit(0).cast("bigint").alias("n_best"),
        F.lit(0).cast("bigint").alias("count_sum"),
        "pairs",
        "times",
    ).schema
    part = materialize(slim.mapInArrow(rows, schema), "aligned-measures")
    asked = part.select("tid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "tid", "x.pairs", "x.times"
    )
    rest = (
        asked.join(counts, asked["pairs"] == counts["pair"])
        .groupBy("tid")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("bigint")).alias("more_best"),
            F.sum(F.col("times") * F.col("count")).alias("more_sum"),
        )
    )
    return part.join(rest, "tid", "left").select(
        "digest",
        "copies",
        *_MEASURES,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def align_documents(
    docs: DataFrame, a: Model, b: Model, *, doc_id="doc_id", text="text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A text is encoded by both models; byte offsets where both end a token cut
    it into groups, and the tokens of a group are linked each with each.  The
    count of an id pair is the number of documents that hold it linked, copies
    included.  Texts that are null or empty, or that either model does not give
    back byte by byte, have no tokens: zeros and an empty digest.  One row per
    row of ``docs``, repeated and null ids as they are; other columns are not
    looked at.  An empty table gives no rows.

    Rows are shuffled by their full text (copies combined before) and each
    distinct text is encoded and aligned once; its pairs count as often as it
    has copies.  Rows get the measures by the text's SHA-256; texts that many
    rows share are joined apart, as a bounded table.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    present = F.coalesce(F.length("text") > 0, F.lit(False))
    distinct = keyed.filter(present).groupBy("text").agg(F.count("*").alias("copies"))
    aligned = align_texts(distinct, a, b)
    measured = materialize(_measured(aligned, pair_counts(aligned)), "text-measures")
    total = measured.agg(F.sum("copies")).first()[0] or 0
    heavy = measured.filter(F.col("copies") * _HEAVY > total)
    light = measured.filter(F.col("copies") * _HEAVY <= total)

    out = [*_MEASURES, "n_best", "count_sum", "groups_sha256"]
    ids = keyed.select("doc_id", F.when(present, F.sha2("text", 256)).alias("digest"))
    # Written once: the digest of every text is asked for by three branches.
    ids = materialize(ids, "text-digests")
    marked = ids.join(F.broadcast(heavy.select("digest", F.struct(*out).alias("m"))), "digest", "left")
    bare = F.col("digest").isNull()
    done = marked.filter(F.col("m").isNotNull()).select("doc_id", "m.*")
    rest = (
        marked.filter(F.col("m").isNull() & ~bare)
        .select("doc_id", "digest")
        .join(light.select("digest", *out), "digest")
        .select("doc_id", *out)
    )
    none = ids.filter(bare).select(
        "doc_id",
        *[F.lit(0).cast("bigint").alias(c) for c in out[:-1]],
        F.lit("").alias("groups_sha256"),
    )
    return done.unionByName(rest).unionByName(none)
