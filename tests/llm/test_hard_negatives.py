"""Products, heaps and mined negatives against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives as hn


def test_strassen():
    rng = np.random.default_rng(0)
    for shape in ((1, 1, 1), (17, 33, 18), (64, 64, 64), (100, 65, 257), (3, 200, 3), (40, 0, 40)):
        n, k, m = shape
        a = rng.integers(-(2**28), 2**28, (n, k))
        b = rng.integers(-(2**28), 2**28, (k, m))
        want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a])
        assert np.array_equal(hn.strassen(a, b), want.reshape(n, m))
    # Sums on the way leave 64 bits, the product does not.
    big = np.full((32, 32), 2**29, np.int64)
    assert (hn.strassen(big, -big) == -(2**63)).all()


def test_heaps():
    rng = np.random.default_rng(1)
    scores = rng.integers(0, 5, (7, 60))
    ids = np.arange(60)
    whole = hn.Heaps(7, 4)
    for j in range(0, 60, 9):
        part = slice(j, j + 9)
        whole.offer(0, scores[:, part], scores[:, part] != 2, ids[part])
    for h in range(7):
        want = sorted((-s, i) for i, s in enumerate(scores[h].tolist()) if s != 2)[:4]
        mine = whole.heap == h
        assert list(zip((-whole.score[mine]).tolist(), whole.id[mine].tolist())) == want


def brute(rows, anchors, k=5):
    out = []
    for a, la, va in anchors:
        score = lambda v: sum(x * y for x, y in zip(va, v))
        same = sorted((-score(v), i) for i, lab, v in rows if lab == la and i != a)[:k]
        for s, p in same:
            near = sorted(
                (-score(v), i)
                for i, lab, v in rows
                if lab != la and i != a and 80 * -s <= 100 * score(v) <= 100 * -s
            )[:k]
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(near, 1)]
    return sorted(out)


@pytest.fixture
def vectors(spark):
    schema = "vec_id long, embedding array<float>, label int, row string, anchor int, i int, j int"

    def build(rows):
        return spark.createDataFrame([(*r, "x", 7, 7, 7) for r in rows], schema)

    return build


def plain(rows):
    keep = []
    for i, v, lab in rows:
        if None in (i, v, lab) or any(x is None or not math.isfinite(x) for x in v):
            continue
        keep.append((i, lab, [math.floor(256 * float(np.float32(x))) for x in v]))
    return keep


def test_mining(vectors, monkeypatch):
    monkeypatch.setattr(hn, "CELL_ROWS", 40)
    monkeypatch.setattr(hn, "TILE_ROWS", 16)
    monkeypatch.setattr(hn, "TILE_ANCHORS", 3)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        v = rng.normal(size=rng.choice([6, 6, 6, 4])).round(1).tolist()
        rows.append((i, v, int(rng.integers(0, 4))))
    rows += [(i, [1.0] * 6, 1 + i % 2) for i in range(300, 380)]  # copies tie
    rows += [(5, [0.5] * 6, 2), (None, [1.0] * 6, 1), (401, None, 1), (402, [1.0], None)]
    rows += [(403, [1.0, None], 1), (404, [float("nan")], 1), (400, [float("inf")], 1)]
    rows += [(406, [], 1), (410, [-1.0] * 6, 9), (420, [], 2), (430, rows[3][1], rows[3][2])]
    keep = plain(rows)
    mined = hn.mine(hn.quantised(vectors(rows)), F.col("vec_id") % 10 == 0)
    got = sorted(tuple(r) for r in mined.collect())
    assert got == brute(keep, [r for r in keep if r[0] % 10 == 0])
    assert mined.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]


def test_nothing_to_mine(vectors):
    for rows in ([], [(0, [1.0], 1)], [(0, [], 1), (1, [], 1)], [(0, [1.0], 1), (1, [2.0], 2)]):
        assert hn.mine(hn.quantised(vectors(rows)), F.col("vec_id") == 0).collect() == []


def test_relabelled(vectors):
    rows = [(i, [float(i % 5)], i % 3) for i in range(40)]
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hn.quantised(vectors(rows), relabel=moved).collect()
    assert {r["vec_id"]: r["label"] for r in found} == {
        i: (i % 3 + 1) % 10 if i % 7 == 0 else i % 3 for i in range(40)
    }
