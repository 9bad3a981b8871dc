"""Cross-tokenizer alignment against a plain version."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import regex
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.queries import BYTE_MODEL, PIECE_MODEL, QUERIES

ODD = [
    "", " ", "  ", "a", "▁", "x▁y", "<|endoftext|> and <s></s><unk><0x0A>", "日本語 текст 🙂🙂 \x00 é\t\n",
    "def f(x):\n    return  x\n", " " * 333, "ab" * 900, "http://abc.de/x?y=%20&z", "0123456789" * 40,
]


def token_bytes(coder, piece):
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    value = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def a(i):
        return bytes(value[c] for c in coder.id_to_token(i))

    def b(i):
        p = piece.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode()

    return a, b


def brute(rows):
    """Rows of the contract for ``(doc_id, text)``."""
    coder = Tokenizer.from_file(public_tokenizers.path(BYTE_MODEL))
    coder.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    left, right = token_bytes(coder, piece)
    docs = []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        if not text or b"".join(map(left, a)) != whole or b"".join(map(right, b)) != whole:
            docs.append((doc_id, [], []))
            continue
        groups, x, y, i, j = [], [], [], 0, 0
        ends = [0, 0]
        while i < len(a) or j < len(b):
            if ends[0] <= ends[1]:
                ends[0] += len(left(a[i]))
                x.append(a[i])
                i += 1
            else:
                ends[1] += len(right(b[j]))
                y.append(b[j])
                j += 1
            if ends[0] == ends[1]:
                groups.append((x, y))
                x, y = [], []
        docs.append((doc_id, groups, [(p, q) for x, y in groups for p in x for q in y]))
    count = Counter(pair for _, _, links in docs for pair in set(links))
    most = defaultdict(int)
    for (p, _), n in count.items():
        most[p] = max(most[p], n)
    out = []
    for doc_id, groups, links in docs:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                doc_id,
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                len(links),
                sum(count[k] == most[k[0]] for k in links),
                sum(count[k] for k in links),
                hashlib.sha256(said.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def models():
    return (
        alignment.Model.load(public_tokenizers.path(BYTE_MODEL)),
        alignment.Model.load(PIECE_MODEL),
    )


def test_query(spark, folder, texts):
    found = QUERIES["op13_aligned_tokenizers"](spark, folder).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(texts.items())


@pytest.mark.parametrize("known, heavy, listed", [(1 << 18, 1000, 1 << 16), (20, 3, 1), (0, 50, 3)])
def test_odd_texts(make, models, monkeypatch, known, heavy, listed):
    """Copies, nulls, repeated ids; any way through the corpus counts."""
    monkeypatch.setattr(alignment, "MOST_KNOWN", known)
    monkeypatch.setattr(alignment, "_HEAVY", heavy)
    monkeypatch.setattr(alignment, "_MOST_LISTED", listed)
    monkeypatch.setattr(alignment, "_SLICE_CHARS", 100)
    rows = [(i, t, "s") for i, t in enumerate(ODD)]
    rows += [(100 + i, "the same text, copied", "s") for i in range(40)]
    rows += [(100, "the same text, copied", "t"), (100, "another", "t"), (None, "another", None)]
    rows += [(None, None, None), (7, None, "s")]
    docs = make(rows).withColumnRenamed("size", "digest").withColumnRenamed("rank", "m")
    found = alignment.align_documents(docs, *models).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute([r[:2] for r in rows])


def test_empty(make, models):
    assert alignment.align_documents(make([]), *models).collect() == []
    nothing = alignment.align_documents(make([(1, None, "s"), (2, "", "s")]), *models).collect()
    assert sorted(map(tuple, nothing)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_ids_of_the_library(models, texts):
    """Every letter and number of either library, runs too long for ranks, odd texts."""
    coder = Tokenizer.from_file(public_tokenizers.path(BYTE_MODEL))
    coder.encode_special_tokens = True
    every = "".join(chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000)
    named = regex.findall(r"[\p{L}\p{N}]", every)
    known = "".join("!" + c for c in named if c not in models[0].unknown)
    other = "".join("a" + c for c in regex.findall(r"[^\p{L}\p{N}\p{Cn}\p{Co}]", every))
    new = sorted(models[0].unknown)[:40]
    some = [known, other, "x" + "!".join(new), "z" * 5000, "q" + " " * 3000 + "q", *ODD, *texts.values()]
    encode = models[0].encoder()
    for text, ids in zip(some, encode(some)):
        assert ids == coder.encode(" " + text, add_special_tokens=False).ids
    assert models[0].ranked and encode.library is not None


def test_unknown_file(tmp_path):
    path = tmp_path / "x.txt"
    path.write_text("")
    with pytest.raises(ValueError):
        alignment.Model.load(str(path))
