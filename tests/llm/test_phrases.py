"""Phrase fingerprints against the plain Lempel-Ziv parse."""

import hashlib

import numpy as np
import pytest

from millrace.llm.phrases import (
    Parsed,
    fingerprint_documents,
    likeness,
    minima,
    parse,
    phrase_hashes,
    signature,
)


def dictionary(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen


def fingerprint(text):
    if not text:
        return ""
    parts = [phrase_hashes(p, 0, [len(p)]) for p in dictionary(text)]
    return signature(minima(np.concatenate(parts)))


TEXTS = ["", "a", "aa", "aaaaaaaaaaa", "abababab" * 50, "é🙂é🙂 the the", "word " * 3000]


@pytest.mark.parametrize("text", TEXTS)
def test_parse(text):
    seen = set()
    ends = parse(text, 0, len(text), seen)
    assert seen == dictionary(text)
    assert ends == sorted(set(ends)) and all(e <= len(text) for e in ends)
    assert Parsed.of(text).fingerprint == fingerprint(text)


def check(docs, rows_per_bucket):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]

    def order(row):
        return (row[0] is not None, row[0] or 0, hashlib.md5(row[1].encode()).hexdigest())

    rows.sort(key=order, reverse=True)
    out = fingerprint_documents(docs, rows_per_bucket=rows_per_bucket).collect()
    got = sorted(map(tuple, out), key=str)
    want = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other = fingerprint(text), fingerprint(edited)
        want.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                own,
                other,
                likeness(own, other),
                likeness(own, fingerprint(following)),
            )
        )
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 1000])
def test_small_tables(make, rows_per_bucket):
    rows = [(i * 7 % 31, f"text {i} " * (i % 4) + "é🙂", "s") for i in range(31)]
    rows += [(3, "another three", "s"), (3, "another three", "s"), (99, "", "s")]
    check(make(rows), rows_per_bucket)


def test_single_empty_and_null(make):
    check(make([(5, "only one", "s")]), 10)
    check(make([(5, None, "s"), (None, "x y z", "s")]), 1)
    assert fingerprint_documents(make([])).collect() == []


def test_given_documents(documents):
    check(documents, 50)
    out = fingerprint_documents(documents).toPandas()
    assert (out.near_edited > out.near_next).mean() > 0.95


def test_parse_cuts_few_pieces():
    """A phrase is cut out of the text when it is looked up, not once more to be kept."""

    class Counted(str):
        cuts = 0

        def __getitem__(self, key):
            Counted.cuts += 1
            return str.__getitem__(self, key)

    rng = np.random.default_rng(3)
    text = Counted("".join("abcd "[k] for k in rng.integers(0, 5, 5000)))
    seen = set()
    ends = parse(text, 0, len(text), seen)
    assert Counted.cuts < 3 * len(ends)
    assert seen == dictionary(str(text))
