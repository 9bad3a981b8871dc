"""The prefix-tree join against brute force over plain word tuples."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ngram_join
from millrace.llm.components import components
from millrace.llm.ngram_join import join_documents, keep_one
from millrace.llm.shingles import shingle_sets
from millrace.llm.trie import join_block, similar

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, width=5):
    lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lowered)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def linked(a, b):
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


def brute(rows):
    """Size and component of each row by comparing all rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        ids = [x for x in ids if x is not None] if sets[i] else [doc_id]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return out


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, join_documents(docs).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    """Near copies of a few texts around the threshold, chains, a common passage."""
    rng = random.Random(1)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = []
    for k in range(4):
        base = [f"w{k}x{rng.randrange(500)}" for _ in range(90)]
        texts += [edited(rng, base, rng.randrange(7)) for _ in range(25)]
        texts += [" ".join(base), " ".join(base).upper()]
        for _ in range(8):  # each a step away from the one before
            base = edited(rng, base, 2).split()
            texts.append(" ".join(base))
        texts += [passage + " " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(5 + 3 * k))] * 2
    rng.shuffle(texts)
    return texts


ODD = ["", None, " \t\n", "one", "ONE", "one two", "a b c d e", "A B  C\nD e", "a b c d e f",
       "é É é É é", "x " * 4000, "x " * 4001]


@pytest.mark.parametrize(
    "frequent, block, rounds, large", [(64, 256, 4, 64), (3, 4, 3, 2), (3, 4, 1, 9), (2, 8, 0, 64)]
)
def test_against_brute_force(make, family, monkeypatch, frequent, block, rounds, large):
    """The same components however sets are ordered, cut into blocks and tried in rounds."""
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", frequent)
    texts = family + ODD
    docs = make([(1000 - 3 * i, t, "s") for i, t in enumerate(texts)]).repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = join_documents(docs, block=block, rounds=rounds, large_group=large).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_repeated_and_missing_ids(make, family):
    rows = [(7, t, "s") for t in family[:3]] + [(7, family[0], "s"), (None, family[0], "s")]
    rows += [(None, None, None), (3, "", "s"), (None, "quite alone in this table", "s")]
    check(make(rows))
    assert join_documents(make([])).collect() == []


def test_given_documents(documents):
    check(documents)


def test_keep_one(make, family):
    docs = make([(i, t, "s") for i, t in enumerate(family + ODD)])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, n, c in brute(list(enumerate(family + ODD))) if i == c}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert keep_one(make([])).collect() == []


def test_keep_one_leaves_other_texts_in_place(make, family):
    """Rows that no component drops are not joined with anything."""
    kept = keep_one(make([(i, t, "s") for i, t in enumerate(family + ODD)]))
    plan = kept._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    assert "Join" not in plan.children().apply(0).toString()


def test_keep_one_of_repeated_and_null_ids(make):
    """A doc_id on several rows, and none, with equal and different texts."""
    x, y, z = ("{} one two three four five six seven eight".format(w) for w in ("x", "y", "z"))
    rows = [
        (1, x, "a"), (2, x, "b"), (2, y, "c"), (3, z, "d"), (3, z, "e"), (3, z, "e"),
        (None, x, "f"), (None, z.replace("one", "two"), "g"), (None, z.replace("one", "two"), "h"),
        (4, "", "i"), (4, "", "j"), (None, None, "k"),
    ]
    kept = keep_one(make(rows))
    assert kept.columns == make([]).columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [
        (1, x), (2, y), (3, z), (None, z.replace("one", "two")), (4, ""), (4, ""), (None, None)
    ]
    assert got == sorted(want, key=str)


def test_tree_join_connects_what_pairs_connect(family):
    sets = [s for s in shingle_sets(pa.array(family)) if len(s)]
    unique = {s.tobytes(): s for s in sets}
    sets = list(unique.values())
    links = join_block(sets, list(range(len(sets))), 80)
    for i, j in links:
        overlap = len(np.intersect1d(sets[i], sets[j]))
        assert similar(overlap, len(sets[i]), len(sets[j]), 80)
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        assert find(i) != find(j)
        up[find(i)] = find(j)
    for i in range(len(sets)):
        for j in range(i):
            overlap = len(np.intersect1d(sets[i], sets[j]))
            if similar(overlap, len(sets[i]), len(sets[j]), 80):
                assert find(i) == find(j)


def test_sketches_bound_the_overlap():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    for n in (1, 5, 300, 600, 2000, 5000):
        for m in (1, 300, 700, 4000):
            a, b = rng.choice(pool, n, False), rng.choice(pool, m, False)
            bound = ngram_join.most_overlap(ngram_join.sketch(a), ngram_join.sketch(b))
            assert len(np.intersect1d(a, b)) <= bound <= min(n, m)
    assert ngram_join.most_overlap(ngram_join.sketch(a), ngram_join.sketch(a)) == len(a)


def test_shingle_hashes_agree_with_words(texts):
    some = list(texts.values())[:150] + ["x" * 3_000_000 + " a b c d e", *ODD]
    plain = [shingles(t) for t in some]
    hashed = shingle_sets(pa.array(some, pa.string()))
    assert [len(s) for s in hashed] == [len(s) for s in plain]
    for i in range(0, len(some), 3):
        for j in range(i):
            common = len(np.intersect1d(hashed[i], hashed[j], assume_unique=True))
            assert common == len(plain[i] & plain[j])


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    other = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    edges = chain + star + other + [(7, 7), (9, 8), (8, 9)]
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            up[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: find(i) for i in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
