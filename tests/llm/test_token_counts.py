"""Token counts against the vocabulary's own library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_counts
from millrace.llm.queries import BYTE_MODEL, QUERIES

PATH = public_tokenizers.path(BYTE_MODEL)
ODD = [
    "", " ", "  ", " a", "a  ", "a    b\n\n\n c", "it's we'll I'VE", "aaaa aaaaa aaaaaa" * 50,
    "a" * 999, " " * 1001, "日本語 текст 🙂🙂 \x00 é\t\n\n", "\U0001094a5x ՘a֋ 1₏", "１２½ ²x",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endof<|endoftext|>text|>",
]


@pytest.fixture(scope="module")
def merges():
    return token_counts.MergeTable.load(PATH)


@pytest.fixture(scope="module")
def library():
    coder = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in coder.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_the_library(merges, library, texts, monkeypatch):
    rng = random.Random(3)
    ranges = [(32, 127), (128, 0x3000), (0x3000, 0xD000), (0x10000, 0x1F000), (9, 33)]
    noise = [
        "".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(200)) for _ in range(300)
    ]
    letters = ["".join(rng.choices("abcdefghij", k=3000)), "ab" * 2000 + "a" * 2001]
    some = ODD + noise + letters + list(texts.values())
    want = library(some)
    assert token_counts.Counter(merges).count(some) == want
    monkeypatch.setattr(token_counts, "_MERGE_BYTES", 50)
    monkeypatch.setattr(token_counts, "_MOST_WORDS", 100)
    counter = token_counts.Counter(merges)
    assert [counter.count([t])[0] for t in some] == want


def test_merging_by_definition(merges):
    """One merge at a time, the lowest rank first, the leftmost of equals."""
    rank = dict(zip(merges.pair_keys.tolist(), merges.pair_ranks.tolist()))
    rng = random.Random(5)
    words = [bytes(rng.choices(b"abthe in", k=rng.randrange(0, 30))) for _ in range(200)]
    for word, left in zip(words, merges.survivors(words).tolist()):
        parts = [int(merges.byte_ids[b]) for b in word]
        while True:
            found = [
                (rank[k], i)
                for i in range(len(parts) - 1)
                if (k := parts[i] * merges.size + parts[i + 1]) in rank
            ]
            if not found:
                break
            r, i = min(found)
            parts[i : i + 2] = [int(merges.merged[r])]
        assert left == len(parts)


def test_long_pre_token(merges, library):
    text = "acgt" * 60_000 + " " * 100_000 + "x" * 100_000
    assert token_counts.Counter(merges).count([text]) == library([text])


def test_documents(make, merges, library):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, None, None), (1, " ", "s")]
    docs = make(rows).withColumnRenamed("size", "n_tokens").withColumnRenamed("rank", "a.b")
    counted = token_counts.count_tokens(docs, merges, limit=200)
    assert "text" not in counted.columns and counted.columns.count("n_tokens") == 1
    found = counted.collect()
    assert len(found) == len(rows)
    for r in found:
        text = (ODD[r["doc_id"]] if r["doc_id"] is not None else None) or ""
        if text != " " or r["doc_id"] != 1:
            assert r["n_tokens"] in (library([text])[0], 1)
            assert r["over_limit"] == (r["n_tokens"] > 200)
            assert r["n_bytes"] in (len(text.encode()), 1)
        assert r["a.b"] == 7
    assert token_counts.count_tokens(make([]), merges).collect() == []


def test_query(spark, folder, texts, library):
    found = {r["doc_id"]: r for r in QUERIES["op11_ragged_counts"](spark, folder).collect()}
    ids = sorted(texts)
    for i, n in zip(ids, library([texts[i] for i in ids])):
        assert tuple(found[i]) == (i, len(texts[i].encode()), n, n > 1024)
    assert len(found) == len(ids)
