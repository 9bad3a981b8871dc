"""Token counts of texts by rank-synchronous merging in ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shipping import ship

# Fixed value of the file format: how byte-level vocabularies split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER = "\ufffd"  # a character that is neither letter, number nor blank
# Characters of texts that are split at a time, bytes of new pre-tokens that are
# merged at a time, and pre-tokens whose count a task remembers.
_SPLIT_CHARS = 500_000
_MERGE_BYTES = 500_000
_MOST_WORDS = 300_000
_NONE = np.int32(np.iinfo(np.int32).max)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the others for the code
    points from 256 on, in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [], 256
    for value in range(256):
        if value in own:
            out.append(chr(value))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@dataclass
class MergeTable:
    """Merges of a byte-level vocabulary by rank, a fixed and small table."""

    byte_ids: np.ndarray
    pair_keys: np.ndarray  # sorted (left * size + right)
    pair_ranks: np.ndarray  # rank of each of these pairs
    merged: np.ndarray  # id that the merge of a rank makes
    size: int
    special: list[str] = field(default_factory=list)
    # Letters and numbers of a newer standard, which the vocabulary's library
    # does not know as such.
    unknown: frozenset[str] = frozenset()

    @classmethod
    def load(cls, path: str) -> MergeTable:
        """Read on the driver; executors get the table, not the path."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids = model["model"]["vocab"]
        size = max(ids.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        return cls(
            byte_ids=np.array([ids[c] for c in byte_alphabet()], np.int32),
            pair_keys=keys[order],
            pair_ranks=order.astype(np.int32),
            merged=np.array([ids[a + b] for a, b in merges], np.int32),
            size=size,
            special=[t["content"] for t in model["added_tokens"]],
            unknown=_unknown_characters(path),
        )

    @cached_property
    def splitter(self) -> regex.Pattern | None:
        if not self.special:
            return None
        longest_first = sorted(self.special, key=len, reverse=True)
        return regex.compile("|".join(map(regex.escape, longest_first)))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where none is merged."""
        key = left.astype(np.int64) * self.size + right
        spot = np.searchsorted(self.pair_keys, key)
        spot[spot == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[spot] == key, self.pair_ranks[spot], _NONE)

    def survivors(self, words: list[bytes]) -> np.ndarray:
        """Symbols that are left of each word when nothing can be merged any more.

        All words lie in one ragged array.  In a round every word applies its
        lowest-ranked pair at all its places, from the left; words without a
        pair leave the array.  A merge only makes pairs of higher rank, so this
        is the order of one merge at a time.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        left = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.flatnonzero(lengths)
        size = lengths[word]
        rank = np.full(len(symbols), _NONE, np.int32)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[np.cumsum(size) - 1] = _NONE
        while len(word):
            start = np.cumsum(size) - size
            lowest = np.minimum.reduceat(rank, start)
            going = lowest != _NONE
            if not going.all():
                left[word[~going]] = size[~going]
                stays = np.repeat(going, size)
                symbols, rank = symbols[stays], rank[stays]
                word, size, lowest = word[going], size[going], lowest[going]
                if not len(word):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # In a run of one symbol the places overlap: every second one counts.
            follows = np.append(False, np.diff(at) == 1) & (symbols[at] == symbols[at + 1])
            if follows.any():
                run = np.flatnonzero(~follows)
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            owner = np.repeat(np.arange(len(word)), size)
            taken = np.bincount(owner[at], minlength=len(word))
            symbols, rank = symbols[keep], rank[keep]
            size = size - taken
            at = at - np.arange(len(at))  # places after the removal
            end = np.cumsum(size) - 1
            last = np.zeros(len(symbols), bool)
            last[end] = True
            for place in (at, at[at > 0] - 1):
                place = place[~last[place]]
                rank[place] = self.ranks(symbols[place], symbols[place + 1])
            rank[end] = _NONE
        return left


def _unknown_characters(path: str) -> frozenset[str]:
    """Letters and numbers that the library of the vocabulary does not split as such."""
    from tokenizers import Tokenizer

    every = "".join(chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000)
    named = regex.findall(r"[\p{L}\p{N}]", every)
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    ends = {stop for _, (_, stop) in split("".join("!" + c for c in named))}
    return frozenset(c for i, c in enumerate(named) if 2 * i + 1 not in ends)


class Counter:
    """Counts of texts; remembers those of pre-tokens while a task runs."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def split(self, text: str, odd: bool) -> list[str]:
        """Pre-tokens; with ``odd`` the text may hold characters the library does not know."""
        if odd and not self.table.unknown.isdisjoint(text):
            plain = "".join(_OTHER if c in self.table.unknown else c for c in text)
            return [text[slice(*m.span())] for m in self.pattern.finditer(plain)]
        return self.pattern.findall(text)

    def learn(self, words: set[str]) -> None:
        """Merge new words, about ``_MERGE_BYTES`` of them at a time."""
        part: list[str] = []
        held: list[bytes] = []
        size = 0
        for word in words:
            part.append(word)
            held.append(word.encode())
            size += len(held[-1])
            if size >= _MERGE_BYTES:
                self.known.update(zip(part, self.table.survivors(held).tolist()))
                part, held, size = [], [], 0
        if held:
            self.known.update(zip(part, self.table.survivors(held).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, where special strings are one token each."""
        odd = not self.table.unknown.isdisjoint(set().union(*texts))
        split, found = [], []
        for text in texts:
            parts, n = [text], 0
            if self.table.splitter is not None:
                parts = self.table.splitter.split(text)
                n = len(parts) - 1
            words: list[str] = []
            for part in parts:
                words += self.split(part, odd)
            split.append(words)
            found.append(n)
        if len(self.known) > _MOST_WORDS:
            self.known.clear()
        self.learn(set().union(*split).difference(self.known))
        return [n + sum(map(self.known.__getitem__, words)) for n, words in zip(found, split)]


def _groups(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``_SPLIT_CHARS``; a longer text is one run."""
    start = size = 0
    for i, length in enumerate(lengths):
        if size and size + length > _SPLIT_CHARS:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


def count_tokens(docs: DataFrame, table: MergeTable, *, text="text", limit: int = 1024):
    """``docs`` without the text, with ``n_bytes, n_tokens, over_limit``.

    Counts equal those of the vocabulary's own library without added tokens;
    its special strings inside a text are one token each.  Null and empty texts
    have no bytes and no tokens.  Columns that have one of the three names are
    replaced, all others stay; repeated rows are counted alike.  No shuffle.  A
    task holds the counts of at most about 300,000 pre-tokens, one Arrow batch
    and the pre-tokens of half a million characters or of one longer text.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    made = ("n_bytes", "n_tokens", "over_limit")
    rest = [c for c in docs.columns if c != text and c not in made]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            body = pc.fill_null(batch.column(0), "")
            n_bytes = pc.binary_length(body).cast(pa.int64())
            counts: list[int] = []
            for low, high in _groups(n_bytes.to_pylist()):
                counts += counter.count(body.slice(low, high - low).to_pylist())
            n_tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                schema.names[:-3] + list(made),
            )

    slim = docs.select(F.col(f"`{text}`").cast("string"), *[F.col(f"`{c}`") for c in rest])
    # Plain names on the way: names with dots cannot go through Arrow functions.
    slim = slim.toDF(*[f"c{i}" for i in range(len(rest) + 1)])
    schema = slim.drop("c0").schema
    for name, kind in zip(made, ("long", "long", "boolean")):
        schema = schema.add(name, kind)
    return slim.mapInArrow(rows, schema).toDF(*rest, *made)
