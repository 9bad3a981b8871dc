"""Piece encoding against the library's own encoder, and back."""

import os

import numpy as np
import pytest
import sentencepiece

from millrace.llm import pieces
from millrace.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no vocabulary file")

ODD = [
    "", " ", "  ", "  a", " a", "a ", "a  ", "a    b", "x▁y", "▁", "▁▁▁▁▁ a", "日本語 текст 🙂🙂 \x00 é\t\n\n",
    "def f(x):\n    return  x\n", "a" * 900, "http://abc.de/x?y=%20&z", "<s></s><unk><0x0A>",
    " " * 33 + "x", " " * 100, "ﬁ ½ ✓✓✓", " nb　sp", "ab" * 20_000,
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_same_ids_as_the_library(vocabulary, library, texts, monkeypatch):
    some = ODD + list(texts.values())
    want = library.encode(some)
    matcher = pieces.Matcher(vocabulary)
    assert matcher.whole
    assert pieces.encode_batch(matcher, some).to_pylist() == want
    monkeypatch.setattr(pieces, "_MOST_WORDS", 500)
    for i, text in enumerate(some):
        assert pieces.encode_batch(matcher, [text]).to_pylist() == [want[i]]
    table = pieces.byte_table(vocabulary)
    for text, ids in zip(some, want):
        assert pieces.decode_ids(table, ids) == text.replace("▁", " ")


def test_merging_by_definition(vocabulary, library, texts):
    for text in ODD[:-1] + [t[:300] for t in list(texts.values())[:30]]:
        marked = "▁" + text.replace(" ", "▁") if text else ""
        ids = []
        for piece in vocabulary.merge(marked):
            if piece >= pieces._UNKNOWN:
                ids += [vocabulary.byte_ids[b] for b in chr(piece - pieces._UNKNOWN).encode()]
            else:
                ids.append(piece)
        assert ids == library.encode(text)


def test_suffix_array(vocabulary):
    matcher = pieces.Matcher(vocabulary)
    text = np.frombuffer("banana bandana abracadabra".encode("utf-32-le"), np.uint32).astype(int)
    order = matcher.suffixes(text)
    keys = [tuple(text[i : i + matcher.width]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(text)))
    word = "".join(map(chr, text))
    start, piece = matcher.occurrences(text)
    want = {
        (i, p) for p, k in vocabulary.ids.items() for i in range(len(word)) if word.startswith(p, i)
    }
    assert {(i, vocabulary.pieces[p]) for i, p in zip(start, piece)} == want


def test_documents(make, vocabulary, library):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, None, None), (1, " ", "s")]
    docs = make(rows).withColumnRenamed("spans", "ids")
    encoded = pieces.encode_documents(docs, vocabulary)
    assert "text" not in encoded.columns and encoded.columns.count("ids") == 1
    decoded = pieces.decode_documents(encoded, vocabulary).collect()
    assert len(decoded) == len(rows)
    for r in decoded:
        text = (ODD[r["doc_id"]] if r["doc_id"] is not None else None) or ""
        assert r["ids"] == library.encode(text) and r["decoded"] == text.replace("▁", " ")
    assert pieces.encode_documents(make([]), vocabulary).collect() == []


def test_long_runs(vocabulary, library):
    """Blanks that pad a table, and words without an end."""
    some = [" " * 100_000, "a" + " " * 99_999 + "b", "x" * 50_000, "\n" * 20_000, "ab c" + "  " * 3001]
    want = library.encode(some)
    assert pieces.encode_batch(pieces.Matcher(vocabulary), some).to_pylist() == want


def test_indexed_in_parts(vocabulary, library, texts, monkeypatch):
    monkeypatch.setattr(pieces, "_INDEX_CHARS", 300)
    some = list(texts.values())[:30]
    assert pieces.encode_batch(pieces.Matcher(vocabulary), some).to_pylist() == library.encode(some)
