"""Exact Jaccard join of word-shingle sets through distributed prefix trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shingles import WIDTH, set_id, shingle_sets
from millrace.llm.shipping import ship
from millrace.llm.texts import spare
from millrace.llm.trie import join_block, similar
from millrace.storage import materialize

PERCENT = 80
# A shingle of at least this many distinct sets is frequent; so many of the most
# frequent ones are known by count (12 bytes each) and come last in the order.
# Both only decide the order of shingles, which is exact for any choice.
FREQUENT_FROM = 64
MOST_FREQUENT = 1 << 20
BLOCK = 256
ROUNDS = 4
# Groups of more sets are joined in blocks before their pairs are looked at.
LARGE_GROUP = 64
_MOST_BINS = 1 << 18
# Size of the bitmap of wanted texts, 4 MiB; a power of two.
_BITMAP_BITS = 1 << 25
_CELL = np.uint64(0xFFFFFF)
_FLUSH = 1_500_000
# Shingles of a bucket at most, on average; it has 2**24 cells.
_BUCKET_SHINGLES = 1 << 22


def sketch(shingles: np.ndarray) -> bytes:
    """Elements per hash bin, about two to a bin: bounds the overlap of two sets.

    One byte each; a bin of 255 or more elements says nothing.
    """
    bins = 64
    while bins < _MOST_BINS and bins * 2 < len(shingles):
        bins *= 2
    place = (shingles & np.uint64(bins - 1)).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=bins), 255).astype(np.uint8).tobytes()


def most_overlap(a: bytes, b: bytes) -> int:
    """No two sets with these sketches share more elements."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if x.max() == 255 or y.max() == 255:
        return 1 << 40
    n = min(len(x), len(y))
    if len(x) != len(y):
        x, y = (v.reshape(-1, n).sum(axis=0, dtype=np.int64) for v in (x, y))
    return int(np.minimum(x, y).sum(dtype=np.int64))


def describe_sets(docs: DataFrame, *, doc_id="doc_id", text="text", width: int = WIDTH):
    """``doc_id, text_key, n, sid, sketch`` per row, of the shingle set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(2), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "text_key", "n", "sid", "sketch"],
            )

    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), F.md5(text).alias("text_key"), F.col(text).alias("text")
    )
    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(rows, f"doc_id {kind}, text_key string, n long, sid long, sketch binary")


def _distinct_sets(
    batches: Iterator[pa.RecordBatch], width: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Sets of a task, equal ones once."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for shingles in shingle_sets(batch.column(0), width):
            if len(shingles):
                key = (set_id(shingles), len(shingles))
                if key not in seen:
                    seen.add(key)
                    yield key[0], shingles


def _cells(shingles: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 24-bit cell of each shingle; a clash can only add candidates."""
    return (shingles % np.uint64(buckets)).astype(np.int64), (
        (shingles >> np.uint64(32)) & _CELL
    ).astype(np.uint32)


def _blobs(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per bucket with the bytes of each column's part."""
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    stops = np.append(starts[1:], len(bucket))
    parts = [c[order] for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(found.astype(np.int32))]
        + [
            pa.array([p[i:j].tobytes() for i, j in zip(starts, stops)], pa.binary())
            for p in parts
        ],
        ["bucket"] + [f"c{i}" for i in range(len(columns))],
    )


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in column.to_pylist()])


def frequent_shingles(
    docs: DataFrame, buckets: int, *, text="text", width=WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent shingle cells, sorted, and their rank by count.

    Every shingle of every distinct set is counted.  Cells travel sorted, as
    16-bit differences that compress to about a byte and a half.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            bucket, cell = _cells(np.concatenate(held), buckets)
            order = np.argsort((bucket.astype(np.uint64) << np.uint64(24)) | cell)
            bucket, cell = bucket[order], cell[order]
            gap = np.diff(cell.astype(np.int64), prepend=0)
            first = np.append(True, bucket[1:] != bucket[:-1])
            gap[first] = cell[first]
            # A gap of more than 16 bits is a high and a low half.
            halves = np.stack([gap >> 16, gap & 0xFFFF], axis=1)
            yield _blobs(
                bucket, [halves[:, 1].astype(np.uint16), halves[:, 0].astype(np.uint8)]
            )
            held.clear()

        size = 0
        for _, shingles in _distinct_sets(batches, width):
            held.append(shingles)
            size += len(shingles)
            if size >= _FLUSH:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def count(key: tuple, table: pa.Table) -> pa.Table:
        cells = [
            np.cumsum(
                np.frombuffer(low, np.uint16).astype(np.int64)
                + (np.frombuffer(high, np.uint8).astype(np.int64) << 16)
            )
            for low, high in zip(table.column("c0").to_pylist(), table.column("c1").to_pylist())
        ]
        values, counts = np.unique(np.concatenate(cells), return_counts=True)
        often = counts >= FREQUENT_FROM
        keys = (np.int64(key[0].as_py()) << 24) | values[often]
        return pa.table({"cell": pa.array(keys, pa.int64()), "sets": pa.array(counts[often])})

    packed = docs.select(text).mapInArrow(pack, "bucket int, c0 binary, c1 binary")
    counted = packed.groupBy("bucket").applyInArrow(count, "cell long, sets long")
    # At most MOST_FREQUENT rows come to the driver.
    top = counted.orderBy(F.desc("sets"), "cell").limit(MOST_FREQUENT).toPandas()
    keys = top["cell"].to_numpy(np.int64)
    rank = np.arange(len(keys), 0, -1)  # the most frequent comes last
    order = np.argsort(keys)
    return keys[order], rank[order]


def prefix_length(n: int, percent: int) -> int:
    """Elements of a set of ``n`` among which any similar set must share one."""
    return n - -(-percent * n // 100) + 1


def postings(
    docs: DataFrame, frequent, buckets: int, percent: int, *, text="text", width=WIDTH
) -> DataFrame:
    """Groups of distinct sets that share a prefix element: ``g, sid, n``.

    Prefix elements are the branches of the distributed tree: its top levels.
    A group is named by its members, so the many elements that a cluster of
    copies shares make one group.  Groups of one set, nearly all, end here.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks = known.value
        held: list[tuple[int, int, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            lengths = [len(p) for _, _, p in held]
            bucket, cell = _cells(np.concatenate([p for _, _, p in held]), buckets)
            sid = np.repeat(np.array([s for s, _, _ in held], np.int64), lengths)
            n = np.repeat(np.array([k for _, k, _ in held], np.int32), lengths)
            yield _blobs(bucket, [cell, sid, n])
            held.clear()

        size = 0
        for sid, shingles in _distinct_sets(batches, width):
            if len(keys):
                bucket, cell = _cells(shingles, buckets)
                at = (bucket << 24) | cell
                spot = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
                rank = np.where(keys[spot] == at, ranks[spot], 0)
                shingles = shingles[np.argsort(rank, kind="stable")]  # already by hash
            prefix = shingles[: prefix_length(len(shingles), percent)]
            held.append((sid, len(shingles), prefix))
            size += len(prefix)
            if size >= _FLUSH // 4:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        cell = _joined(table.column("c0"), np.uint32)
        sid = _joined(table.column("c1"), np.int64)
        n = _joined(table.column("c2"), np.int32)
        order = np.lexsort((sid, n, cell))
        cell, sid, n = cell[order], sid[order], n[order]
        new = np.append(True, (cell[1:] != cell[:-1]) | (sid[1:] != sid[:-1]) | (n[1:] != n[:-1]))
        cell, sid, n = cell[new], sid[new], n[new]
        # By size inside a cell: a member counts if a neighbour's size can match.
        near = (cell[1:] == cell[:-1]) & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64))
        keep = np.append(near, False) | np.append(False, near)
        # A group ends where sizes stop matching.
        group = np.cumsum(np.append(True, ~near))[keep]
        sid, n = sid[keep], n[keep]
        if len(sid):
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            hashed = (sid.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(
                0xD6E8FEB86659FD93
            )
            hashed = (hashed ^ (hashed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            name = np.add.reduceat(hashed, starts).astype(np.int64)
            g = np.repeat(name, np.diff(np.append(starts, len(sid))))
            # Groups of the same members once per bucket.
            pairs = pd.DataFrame({"g": g, "sid": sid, "n": n.astype(np.int64)}).drop_duplicates()
        else:
            pairs = pd.DataFrame({"g": [], "sid": [], "n": []}, dtype="int64")
        return pa.Table.from_pandas(pairs, preserve_index=False)

    packed = docs.select(text).mapInArrow(emit, "bucket int, c0 binary, c1 binary, c2 binary")
    met = packed.groupBy("bucket").applyInArrow(meet, "g long, sid long, n long")
    return met.distinct()


def _join_blocks(blocks: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between labels, ``a, b``, from ``block, salt, label, text`` rows."""

    def links(table: pa.Table) -> pa.Table:
        sets = shingle_sets(table.column("text").combine_chunks(), width)
        labels = table.column("label").to_pylist()
        found = [(labels[i], labels[j]) for i, j in join_block(sets, labels, percent)]
        return pa.table(
            {
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64()),
            }
        )

    slim = blocks.select("block", "salt", "label", "text")
    return slim.groupBy("block", "salt").applyInArrow(links, "a long, b long")


def _place(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(_BITMAP_BITS))


def _bitmap(keys: DataFrame, *columns: str) -> np.ndarray:
    """Bits at the places of the keys: what lies elsewhere is surely not one of them."""
    word = F.shiftright(_place(*columns), 6)
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(*columns), F.lit(64)).cast("int")
    )
    words = keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    # At most _BITMAP_BITS / 64 rows of two numbers.
    found = words.toPandas()
    bitmap = np.zeros(_BITMAP_BITS // 64, np.int64)
    bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bitmap


def _with_texts(sids: DataFrame, chosen: DataFrame, texts: DataFrame) -> DataFrame:
    """``sid, text`` of one text per set; other texts do not leave their task.

    A bitmap of fixed size says which digests may be wanted; only such texts
    reach the exact join.  If very many are wanted it lets more pass, never
    less.
    """
    keys = materialize(sids.join(chosen, "sid").select("sid", "text_key"), "ngram-keys")
    shared = texts.sparkSession.sparkContext.broadcast(_bitmap(keys, "text_key"))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            hit = (shared.value[at >> 6] >> (at & 63)) & 1 == 1
            if hit.any():
                yield batch.filter(pa.array(hit))

    place = _place("text_key").alias("place")
    passed = (
        texts.filter("text_key IS NOT NULL")
        .select(place, "text_key", "text")
        .mapInArrow(maybe, "place long, text_key string, text string")
    )
    # One plan for every size: the keys grow with the corpus, so no broadcast.
    both = passed.join(keys.hint("merge"), "text_key").select("sid", "text")
    return both.dropDuplicates(["sid"])


def _possible(pairs: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches leave room for the threshold; drops no similar pair."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column("a_n").to_pylist(), batch.column("b_n").to_pylist())
            bounds = zip(batch.column("a_sketch").to_pylist(), batch.column("b_sketch").to_pylist())
            keep = [
                similar(most_overlap(x, y), a, b, percent)
                for (a, b), (x, y) in zip(sizes, bounds)
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select(
                ["a", "a_label", "b", "b_label"]
            )

    open_pairs = (
        pairs.filter("a_label <> b_label")
        .filter(f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)")
        .select(
            F.col("a_sid").alias("a"), "a_n", "a_label", F.col("b_sid").alias("b"), "b_n", "b_label"
        )
        .distinct()
    )
    a = chosen.select(F.col("sid").alias("a"), F.col("sketch").alias("a_sketch"))
    b = chosen.select(F.col("sid").alias("b"), F.col("sketch").alias("b_sketch"))
    both = open_pairs.join(a, "a").join(b, "b")
    return both.mapInArrow(rows, "a long, a_label long, b long, b_label long")


def possible_in_cell(
    table: pa.Table, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``a, b`` of a cell that may be similar and are in different components.

    ``i, j, part, n, label, sketch``: in a cell of two parts only pairs across
    them are looked at.  Of the sketches the first 64 bins rule most pairs out
    for one row at once.
    """
    n = table["n"].to_numpy()
    label = table["label"].to_numpy()
    part = table["part"].to_numpy()
    sketches = table["sketch"].to_pylist()
    across = table["i"][0].as_py() != table["j"][0].as_py()
    fine = [np.frombuffer(x, np.uint8) for x in sketches]
    # A bin that is full bounds nothing.
    coarse = np.array(
        [
            np.full(64, 1 << 32) if x.max() == 255 else x.reshape(-1, 64).sum(axis=0, dtype=np.int64)
            for x in fine
        ],
        np.int64,
    )
    found: list[tuple[int, int]] = []
    for row in range(len(n) - 1):
        later = slice(row + 1, None)
        fits = label[later] != label[row]
        if across:
            fits &= part[later] != part[row]
        fits &= 100 * np.minimum(n[later], n[row]) >= percent * np.maximum(n[later], n[row])
        at = row + 1 + np.flatnonzero(fits)
        if not len(at):
            continue
        overlap = np.minimum(coarse[at], coarse[row]).sum(axis=1)
        # 100 * overlap >= percent * (sum of sizes - overlap), as in ``similar``.
        at = at[(100 + percent) * overlap >= percent * (n[at] + n[row])]
        found += [
            (row, k)
            for k in at.tolist()
            if similar(most_overlap(sketches[row], sketches[k]), int(n[row]), int(n[k]), percent)
        ]
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _possible_in_groups(
    groups: DataFrame, labels: DataFrame, chosen: DataFrame, percent: int, block: int
) -> DataFrame:
    """Pairs of open groups whose sketches leave room for the threshold.

    The members of a group meet in one place, so what is shuffled grows with
    the members and not with their pairs; a larger group is dealt into parts of
    about ``block`` members, and each two parts are a cell of their own.
    """
    placed = groups.join(labels, "sid")
    unsettled = (
        placed.groupBy("g")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m"))
        .filter("low <> high")
        .select("g", F.ceil(F.col("m") / block).alias("parts"))
    )
    # Written: the size of the cells is known before they are dealt.
    open_sets = materialize(placed.join(unsettled, "g"), "ngram-open")
    sketches = chosen.select("sid", "sketch")
    dealt = open_sets.join(sketches, "sid").withColumn("part", F.pmod(F.xxhash64("sid"), "parts"))
    cells = dealt.withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    ).select(
        "g",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        "part",
        "sid",
        "n",
        "label",
        "sketch",
    )
    names = ["a", "a_label", "b", "b_label"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by cell; the last cell of a batch may go on in the next.
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table[k].to_numpy() for k in ("g", "i", "j")])
            starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            sid, label = table["sid"].to_numpy(), table["label"].to_numpy()
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for low, high in zip(starts, np.append(starts[1:], table.num_rows)):
                if high - low > 1:
                    a, b = possible_in_cell(table.slice(low, high - low), percent)
                    left.append(a + low)
                    right.append(b + low)
            a, b = np.concatenate(left), np.concatenate(right)
            # The smaller id first, so that groups that share a pair agree.
            a, b = np.where(sid[a] < sid[b], a, b), np.where(sid[a] < sid[b], b, a)
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (sid[a], label[a], sid[b], label[b])], names
            )

        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
            last = int(cut[-1]) + 1 if len(cut) else 0
            if held:
                first = held[-1]
                goes_on = all(first.column(k)[-1] == batch.column(k)[0] for k in range(3))
                if not goes_on or last:
                    done = [*held, batch.slice(0, last)] if goes_on else held
                    yield pairs(pa.Table.from_batches(done))
                    held = []
                    if goes_on:
                        batch, last = batch.slice(last), 0
            if last:
                yield pairs(pa.Table.from_batches([batch.slice(0, last)]))
                batch = batch.slice(last)
            held.append(batch)
        if held:
            yield pairs(pa.Table.from_batches(held))

    spread = cells.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return spread.mapInArrow(rows, "a long, a_label long, b long, b_label long").distinct()


def _settle(
    possible: DataFrame,
    labels: DataFrame,
    chosen: DataFrame,
    texts: DataFrame,
    percent: int,
    width: int,
    block: int,
) -> DataFrame:
    """Labels after the possible pairs between different components are compared."""
    left = materialize(possible, "ngram-pairs")
    many = left.groupBy("a", "a_label").agg(F.ceil(F.count("*") / block).alias("parts"))
    spread = left.join(many.select("a", "parts"), "a").select(
        F.col("a").alias("block"),
        F.pmod(F.xxhash64("b"), "parts").alias("salt"),
        F.col("b").alias("sid"),
        F.col("b_label").alias("label"),
    )
    centres = many.select(
        F.col("a").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("salt"),
        F.col("a").alias("sid"),
        F.col("a_label").alias("label"),
    )
    wanted = materialize(spread.unionByName(centres), "ngram-wanted")
    blocks = wanted.join(_with_texts(wanted.select("sid").distinct(), chosen, texts), "sid")
    return _relabel(labels, materialize(_join_blocks(blocks, percent, width), "ngram-links"))


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    merged = components(links)
    moved = labels.join(merged, labels["label"] == merged["node"], "left")
    return materialize(
        moved.select("sid", F.coalesce("root", "label").alias("label")), "ngram-labels"
    )


def join_documents(
    docs: DataFrame,
    *,
    doc_id="doc_id",
    text="text",
    percent: int = PERCENT,
    width: int = WIDTH,
    rounds: int = ROUNDS,
    block: int = BLOCK,
    large_group: int = LARGE_GROUP,
) -> DataFrame:
    """Components of documents linked by Jaccard similarity of their shingles.

    Returns ``doc_id, n_shingles, component_id``, one row per row of ``docs``;
    the component is the smallest doc_id reachable.  Null and empty texts and
    texts without a word have an empty set, no link and themselves as component
    (null for a null doc_id).  Equal sets are one node.  Rows that repeat a
    doc_id keep their own texts.  Empty table: empty result.  Other columns are
    ignored.

    1. Shingles are counted to put frequent ones last in the global order.
    2. Sets that share a prefix element meet in a group (`postings`).
    3. In a few rounds, open groups (of more than one component) of more than
       ``large_group`` sets are cut into blocks of ``block`` sets; each block is
       joined by a local prefix tree.  Connected sets are not compared again,
       so a cluster of thousands of near copies costs a few blocks, not its
       pairs.
    4. Each set is paired with one set of each of its groups.  Then the members
       of groups that still hold several components meet in cells of bounded
       size, where sketches rule out pairs before any of them is a row.  The
       pairs whose sketches leave room for the threshold are joined by a prefix
       tree around one of the two: exact, whatever the rounds left.

    Links between sets are complete as far as components go; pairs inside a
    component are not listed.
    """
    spark = docs.sparkSession
    ship(spark)
    described = materialize(
        describe_sets(docs, doc_id=doc_id, text=text, width=width), "ngram-sets"
    )
    # A bucket is one group of a task: as many as keep it small, whatever the session says.
    total = described.agg(F.sum("n")).first()[0] or 0
    buckets = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // _BUCKET_SHINGLES)
    )
    frequent = frequent_shingles(docs, buckets, text=text, width=width)
    groups = materialize(
        postings(docs, frequent, buckets, percent, text=text, width=width), "ngram-groups"
    )
    open_sets = groups.select("sid").distinct()
    # One text of each set that is in a group, found by the digest of the text.
    chosen = (
        described.filter("n > 0")
        .join(open_sets, "sid", "left_semi")
        .groupBy("sid")
        .agg(F.min("text_key").alias("text_key"), F.min("sketch").alias("sketch"))
    )
    chosen = materialize(chosen, "ngram-chosen")
    texts = docs.select(F.md5(text).alias("text_key"), F.col(text).alias("text"))
    labels = open_sets.select("sid", F.col("sid").alias("label"))
    large = groups.groupBy("g").agg(F.count("*").alias("m")).filter(F.col("m") > large_group)
    large = materialize(large, "ngram-large")
    crowded = materialize(groups.join(large, "g"), "ngram-crowded")
    members = _with_texts(crowded.select("sid").distinct(), chosen, texts)
    turns = 0 if crowded.isEmpty() else rounds
    if turns:
        members = materialize(members, "ngram-members")
    for turn in range(turns):
        placed = crowded.join(labels, "sid")
        unsettled = (
            placed.groupBy("g")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low <> high")
            .select("g")
        )
        still = placed.join(unsettled, "g")
        if turn:
            # Of a component that is large already, some sets are enough to try.
            few = Window.partitionBy("g", "label").orderBy(F.xxhash64("sid", F.lit(turn)))
            still = still.withColumn("nth", F.row_number().over(few)).filter("nth <= 8")
        choice = F.max_by("g", F.struct("m", F.xxhash64("g", F.lit(turn))))
        picked = materialize(
            still.groupBy("sid", "label").agg(choice.alias("block")), "ngram-picked"
        )
        sizes = picked.groupBy("block").agg(
            F.count("*").alias("rows"), F.countDistinct("label").alias("kinds")
        )
        sizes = sizes.filter("kinds > 1")
        salt = F.pmod(F.xxhash64("sid", F.lit(turn)), F.ceil(F.col("rows") / block))
        blocks = (
            picked.join(sizes, "block")
            .select("sid", "label", "block", salt.alias("salt"))
            .join(members, "sid")
        )
        links = materialize(_join_blocks(blocks, percent, width), "ngram-links")
        if links.isEmpty():
            break
        labels = _relabel(labels, links)
    # Each set of a group against one of them: a line of pairs, not all.
    placed = groups.join(labels, "sid")
    first = placed.groupBy("g").agg(
        F.min_by(F.struct("sid", "n", "label"), F.xxhash64("sid")).alias("first")
    )
    one = placed.join(first, "g").select(
        *[F.col(f"first.{c}").alias(f"a_{c}") for c in ("sid", "n", "label")],
        *[F.col(c).alias(f"b_{c}") for c in ("sid", "n", "label")],
    )
    possible = _possible(one, chosen, percent)
    labels = _settle(possible, labels, chosen, texts, percent, width, block)
    # Then whatever still shares a group but no component.
    possible = _possible_in_groups(groups, labels, chosen, percent, block)
    labels = _settle(possible, labels, chosen, texts, percent, width, block)
    # Documents to sets to components to smallest ids; sets in no group are alone.
    filled = described.filter("n > 0").join(labels, "sid", "left")
    filled = filled.select("doc_id", "n", F.coalesce("label", "sid").alias("label"))
    smallest = filled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = filled.join(smallest, "label")
    alone = described.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*out).unionByName(alone.select(*out))


def keep_one(docs: DataFrame, *, doc_id="doc_id", text="text", **options) -> DataFrame:
    """One row of each component: smallest doc_id, nulls last, then text digest.

    Keeps the columns of ``docs``, whatever their names.  Rows without words stay.  Rows are told
    apart by doc_id and digest, so a repeated or null doc_id neither takes rows
    of other components along nor keeps copies.  Of rows equal in both one
    stays, by a hash of all columns.
    """
    own, body = spare(docs, "own_id"), spare(docs, "own_digest")
    digest = F.coalesce(F.md5(text), F.lit(""))
    key = F.struct(
        F.col(doc_id).isNull().alias("missing"),
        F.col(doc_id).alias("id"),
        digest.alias("digest"),
    )
    joined = materialize(
        join_documents(
            docs.select(key.alias("key"), F.col(text).alias("text")),
            doc_id="key",
            text="text",
            **options,
        ),
        "ngram-joined",
    )
    joined = joined.filter("n_shingles > 0").withColumn(
        "first", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    # Keys whose rows all go, and keys of several rows of which one comes back.
    cut = materialize(
        joined.groupBy("doc_id", "first")
        .agg(F.count("*").alias("rows"))
        .filter("NOT first OR rows > 1")
        .select(F.col("doc_id.id").alias(own), F.col("doc_id.digest").alias(body), "first"),
        "ngram-gone",
    )
    # Rows that are surely none of them stay where they are: texts are not moved.
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(cut, own, body))

    @F.pandas_udf("boolean")
    def maybe(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((shared.value[at >> 6] >> (at & 63)) & 1 == 1)

    flag = spare(docs, "may_go")
    place = F.pmod(F.xxhash64(F.col(doc_id), digest), F.lit(_BITMAP_BITS))
    flagged = docs.withColumn(flag, maybe(place))
    stay = flagged.filter(~F.col(flag)).drop(flag)
    some = flagged.filter(flag).drop(flag)
    same = some[doc_id].eqNullSafe(cut[own]) & (digest == cut[body])
    kept = stay.unionByName(some.join(cut, same, "left_anti"))
    again = some.join(cut.filter("first").drop("first"), same).groupBy(own, body)
    one = again.agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
    )
    return kept.unionByName(one.select("row.*"))
