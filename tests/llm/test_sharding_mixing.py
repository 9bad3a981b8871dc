import zlib
from collections import Counter

import pytest

from millrace.llm.mixing import emit_mix, plan_mix, source_targets
from millrace.llm.sharding import stratified_shards

ROWS = [(i, f"word {i} " * (i % 5), f"s{i % 3}" if i % 7 else None) for i in range(60)]
ODD = [(None, None, None), (None, "", "s0"), (5, "x", "s0"), (5, "x", "s0"), (5, "é\n", "s1")]


def test_shards_keep_the_mixture(make):
    rows = stratified_shards(make(ROWS + ODD), shards=4, rows_per_slice=3).collect()
    assert len(rows) == 65
    by_shard = Counter(r["shard"] for r in rows)
    assert sorted(by_shard.values()) == [16, 16, 16, 17]
    for shard, n in by_shard.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    for source in ("s0", "s1", "s2", None):
        per = Counter(r["shard"] for r in rows if r["source"] == source)
        total = sum(per.values())
        assert all(abs(per[k] - total / 4) <= 2 for k in range(4))
        assert sorted(r["rank"] for r in rows if r["source"] == source) == list(
            range(1, total + 1)
        )
    for r in rows:
        if r["doc_id"] is None and r["source"] is None:
            assert (r["size"], r["text_crc32"]) == (1, 0)
    crc = {zlib.crc32(t.encode()) for _, t, _ in ROWS + ODD if t}
    assert crc <= {r["text_crc32"] for r in rows}


def test_slices_do_not_change_the_order(make):
    docs = make(ROWS)
    fine = stratified_shards(docs, shards=5, rows_per_slice=2).collect()
    coarse = stratified_shards(docs, shards=5, rows_per_slice=1000).collect()
    assert sorted(map(tuple, fine), key=str) == sorted(map(tuple, coarse), key=str)


def test_few_and_no_rows(make):
    assert stratified_shards(make([]), shards=4).collect() == []
    rows = stratified_shards(make([(1, "a", "s"), (2, "b", "t")]), shards=16).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (1, 0)]


def filled(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by repeated sharing of what is left."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = {}, share * sum(sizes.values())
    free = set(names)
    while free:
        each = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * each >= cap * sizes[s]}
        if not full:
            return target | {s: weight[s] * each for s in free}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 30, None: 5},
        {"a": 100},
        {"a": 0, "b": 50, "c": 50},
        {"é": 7, "z": 9, "Z": 1, "b": 400, "c": 3},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r for r in source_targets(df).collect()}
    for source, want in filled(sizes).items():
        assert got[source]["target"] == pytest.approx(want)
        assert got[source]["rate"] <= 2


def test_mix(make):
    docs = make(ROWS + ODD)
    plan = plan_mix(docs).collect()
    assert len(plan) == len(ROWS + ODD)
    assert all(0 <= r["copies"] <= 2 for r in plan)
    assert [r["size"] for r in plan if r["doc_id"] is None] == [0, 0]
    assert sorted(map(str, plan_mix(docs).collect())) == sorted(map(str, plan))
    emitted = emit_mix(docs)
    assert emitted.columns == docs.columns
    assert emitted.count() == sum(r["copies"] for r in plan)
    assert plan_mix(make([])).collect() == [] and emit_mix(make([])).collect() == []


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "repeat('w ', cast(id % 13 AS int)) AS text", "concat('s', id % 4) AS source"
    )
    rows = plan_mix(docs).selectExpr("source", "target", "size * copies AS taken").collect()
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
    for source, target in {(r["source"], r["target"]) for r in rows}:
        assert taken[source] == pytest.approx(target, rel=0.05)
