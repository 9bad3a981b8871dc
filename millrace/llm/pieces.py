"""Encoding texts into vocabulary pieces by suffix-array matching, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shipping import ship

# Fixed values of the file format: the mark that stands for a blank.
MARK = "▁"
# Characters of texts that are encoded together, characters of new words that are
# indexed together, and words a task remembers.
_BATCH_CHARS = 1_000_000
_INDEX_CHARS = 400_000
_MOST_WORDS = 300_000
_UNKNOWN = 1 << 22  # added to the code point of a character without a piece
_UNSET, _START = -2, -1


@dataclass
class Vocabulary:
    """Pieces and scores of a model with byte fallback, a fixed and small table."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]
    ids: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read on the driver; executors get the table, not the path."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in every]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in every]
        return cls(
            pieces,
            [model.get_score(i) for i in every],
            [not s for s in special],
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        )

    def __post_init__(self):
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, self.normal)) if ok}

    @property
    def splits_at_blanks(self) -> bool:
        """No piece continues over a blank, so words can be encoded apart."""
        return not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)

    def merge(self, text: str) -> list[int]:
        """Encoding by definition: merge the best neighbours, leftmost first.

        A character without a piece is ``_UNKNOWN`` plus its code point.  Parts
        are linked to their neighbours and pairs wait in a heap, so the time
        grows little faster than the text.
        """
        parts: list[str] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                piece = self.ids.get(parts[i] + parts[j])
                if piece is not None:
                    heapq.heappush(heap, (-self.scores[piece], i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            # A part that was merged away is empty.
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ids.get(p, _UNKNOWN + ord(p[0])) for p in parts if p]


class _Numbering(dict):
    """Numbers for words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Matcher:
    """Encodes batches of words; remembers words and which pieces can follow each other."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.normal = np.array(sorted(v.ids.values()), np.int64)
        self.length = np.array([len(p) for p in v.pieces] + [1], np.int64)
        self.width = int(self.length[self.normal].max())
        self.codes = np.full((len(self.normal), self.width), -1, np.int32)
        for row, i in enumerate(self.normal):
            self.codes[row, : len(v.pieces[i])] = [ord(c) for c in v.pieces[i]]
        # Known answers: sorted keys of (previous, piece) and whether they may follow.
        self.keys = np.zeros(0, np.int64)
        self.fits = np.zeros(0, bool)
        self.whole = v.splits_at_blanks
        self._forget()

    def _forget(self) -> None:
        self.words = _Numbering()
        self.flat = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def remembered(self) -> _Numbering:
        """Words with their numbers; asking for a new one numbers it.

        What was learned is dropped before a batch if it is too much.
        """
        if len(self.words) > _MOST_WORDS:
            self._forget()
        return self.words

    def learn(self) -> None:
        """Match the words numbered since the last time, in batch texts of some size."""
        new = [MARK + u for u in islice(self.words, len(self.count), None)]
        flat, counts = [self.flat], [self.count]
        for low, high in _groups([len(u) for u in new], _INDEX_CHARS):
            ids, lengths = self.encode(new[low:high])
            flat.append(ids.astype(np.int32))
            counts.append(lengths)
        self.flat = np.concatenate(flat)
        self.count = np.concatenate(counts)
        self.begin = np.cumsum(self.count) - self.count

    def suffixes(self, text: np.ndarray) -> np.ndarray:
        """Positions ordered by the ``width`` characters that follow, by doubling."""
        rank = np.cumsum(np.bincount(text) > 0)[text]
        order, reach = None, 1
        while True:
            key = rank * (len(rank) + 1)
            if reach < len(rank):
                key[:-reach] += rank[reach:]
            order = np.argsort(key)
            reach *= 2
            new = np.append(True, np.diff(key[order]) != 0)
            rank[order] = np.cumsum(new)
            if reach >= self.width or new.all():
                return order

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and piece of every occurrence, each piece searched in the suffix array."""
        order = self.suffixes(text)
        present = np.unique(text)
        usable = (np.isin(self.codes, present) | (self.codes < 0)).all(axis=1)
        padded = np.append(text, np.full(self.width, -1)).astype(np.int32)
        heads = text[order]
        starts, pieces = [], []
        # Short pieces need few characters compared.
        longest = self.length[self.normal]
        for least, most in ((1, 4), (5, 8), (9, self.width)):
            rows = np.flatnonzero(usable & (longest >= least) & (longest <= most))
            codes = self.codes[rows, :most]
            begin = self._search(order, padded, heads, codes, False)
            counts = self._search(order, padded, heads, codes, True) - begin
            first = np.repeat(begin - np.append(0, np.cumsum(counts)[:-1]), counts)
            starts.append(order[first + np.arange(len(first))])
            pieces.append(np.repeat(self.normal[rows], counts))
        return np.concatenate(starts), np.concatenate(pieces)

    @staticmethod
    def _search(
        order: np.ndarray, padded: np.ndarray, heads: np.ndarray, codes: np.ndarray, after: bool
    ) -> np.ndarray:
        """First place in the suffix array not before each piece, or after all it begins."""
        if not len(codes):
            return np.zeros(0, np.int64)
        low = np.searchsorted(heads, codes[:, 0], "left")
        high = np.searchsorted(heads, codes[:, 0], "right")
        columns = np.arange(codes.shape[1])
        while True:
            rows = np.flatnonzero(low < high)
            if not len(rows):
                return low
            middle = (low[rows] + high[rows]) // 2
            block = padded[order[middle][:, None] + columns]
            wanted = codes[rows]
            differs = (block != wanted) & (wanted >= 0)
            first = differs.argmax(axis=1)
            pick = np.arange(len(rows))
            less = np.where(
                differs[pick, first], block[pick, first] < wanted[pick, first], after
            )
            low[rows[less]] = middle[less] + 1
            high[rows[~less]] = middle[~less]

    def may_follow(self, previous: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merging the joined characters gives back just these two pieces."""
        size = len(self.v.pieces)
        alone = (previous == _START) | (previous >= _UNKNOWN)
        keys = np.where(alone, size, previous) * (size + 1) + piece
        unique, inverse = np.unique(keys, return_inverse=True)
        spot = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = spot < len(self.keys)
        known[inside] = self.keys[spot[inside]] == unique[inside]
        new = unique[~known]
        if len(new):
            text = self.v.pieces
            answers = []
            for a, b in zip((new // (size + 1)).tolist(), (new % (size + 1)).tolist()):
                head = [] if a == size else [a]
                answers.append(
                    self.v.merge("".join(text[i] for i in head) + text[b]) == head + [b]
                )
            place = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, place, new)
            self.fits = np.insert(self.fits, place, answers)
        return self.fits[np.searchsorted(self.keys, unique)][inverse]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and the number of ids per unit.

        Edges are relaxed in order of their end: the last piece before a place
        is the one that may follow the last piece before its own start.  Two
        neighbours that merge back to themselves are part of the same encoding,
        so one such piece exists for every place.
        """
        lengths = np.array([len(u) for u in units], np.int64)
        text = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(text):
            return np.zeros(0, np.int64), np.zeros(len(units), np.int64)
        bounds = np.append(0, np.cumsum(lengths))
        unit = np.repeat(np.arange(len(units)), lengths)
        start, piece = self.occurrences(text)
        stop = start + self.length[piece]
        inside = stop <= bounds[unit[start] + 1]
        start, piece = start[inside], piece[inside]
        single = np.zeros(len(text), bool)
        single[start[self.length[piece] == 1]] = True
        missing = np.flatnonzero(~single)
        start = np.append(start, missing)
        piece = np.append(piece, _UNKNOWN + text[missing])
        size = self.length[np.minimum(piece, len(self.v.pieces))]
        # A place inside a unit: its character plus the number of units before.
        end_in_unit = start - bounds[unit[start]] + size
        # Small numbers are sorted by counting.
        small = np.uint16 if end_in_unit.max() < 1 << 16 else np.int64
        order = np.argsort(end_in_unit.astype(small), kind="stable")
        start, piece, size, end = start[order], piece[order], size[order], end_in_unit[order]
        place = start + unit[start]
        last = np.full(len(text) + len(units), _UNSET, np.int64)
        last[bounds[:-1] + np.arange(len(units))] = _START
        cuts = np.flatnonzero(np.append(True, np.diff(end) != 0))
        for low, high in zip(cuts, np.append(cuts[1:], len(end))):
            at, new = place[low:high], piece[low:high]
            before = last[at]
            fits = before != _UNSET
            check = fits & (new < _UNKNOWN)
            fits[check] = self.may_follow(before[check], new[check])
            last[at[fits] + size[low:high][fits]] = new[fits]
        return self._trace(units, bounds, last)

    def _trace(self, units: list[str], bounds: np.ndarray, last: np.ndarray):
        own = np.arange(len(units))
        start = bounds[:-1] + own
        cursor = bounds[1:] + own
        which, found = [], []
        active = np.flatnonzero(cursor > start)
        lost = np.zeros(len(units), bool)
        while len(active):
            piece = last[cursor[active]]
            lost[active[piece == _UNSET]] = True
            active, piece = active[piece != _UNSET], piece[piece != _UNSET]
            which.append(active)
            found.append(piece)
            cursor[active] -= self.length[np.minimum(piece, len(self.v.pieces))]
            active = active[cursor[active] > start[active]]
        which = np.concatenate(which)[::-1]
        found = np.concatenate(found)[::-1]
        # Repeated blanks tie in score; there the definition decides.
        again = np.flatnonzero(lost | np.array([u.startswith(MARK * 2) for u in units]))
        if len(again):
            keep = ~np.isin(which, again)
            redone = [self.v.merge(units[i]) for i in again]
            which = np.append(which[keep], np.repeat(again, [len(r) for r in redone]))
            found = np.append(found[keep], np.concatenate([np.array(r, np.int64) for r in redone]))
        order = np.argsort(which, kind="stable")
        which, found = which[order], found[order]
        if (found >= _UNKNOWN).any():
            which, found = self._spell(which, found)
        return found, np.bincount(which, minlength=len(units))

    def _spell(self, which: np.ndarray, found: np.ndarray):
        """Characters without a piece as the ids of their bytes."""
        strange = np.unique(found[found >= _UNKNOWN])
        spelled = [
            [self.v.byte_ids[b] for b in chr(c - _UNKNOWN).encode("utf-8", "replace")]
            for c in strange.tolist()
        ]
        many = np.ones(len(found), np.int64)
        odd = found >= _UNKNOWN
        spot = np.searchsorted(strange, found[odd])
        many[odd] = np.array([len(s) for s in spelled])[spot]
        out = np.repeat(found, many)
        first = np.cumsum(many) - many
        for k in range(4):
            has = np.array([len(s) > k for s in spelled])[spot]
            value = np.array([s[k] if len(s) > k else 0 for s in spelled])[spot]
            out[first[odd][has] + k] = value[has]
        return np.repeat(which, many), out


def units_of(text: str, whole: bool) -> list[str]:
    """Words with the blanks before them, each without its first mark."""
    if not whole:
        return [text.replace(" ", MARK)]
    if "  " not in text and MARK not in text and not text.startswith(" "):
        return text.split(" ")
    marked = MARK + text.replace(" ", MARK)
    return [u[1:] for u in re.findall(f"{MARK}+[^{MARK}]+|{MARK}+$", marked)]


def _groups(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters; a longer text is one run."""
    start = size = 0
    for i, length in enumerate(lengths):
        if size and size + length > most:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


def encode_batch(matcher: Matcher, texts: list[str]) -> pa.ListArray:
    """Ids per text: words that are new to the matcher are matched, each once."""
    counts, words = [], []
    known = matcher.remembered()
    for text in texts:
        units = units_of(text, matcher.whole) if text else []
        words.extend(map(known.__getitem__, units))
        counts.append(len(units))
    matcher.learn()
    index = np.array(words, np.int64)
    sizes = matcher.count[index] if len(index) else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    flat = matcher.flat[
        np.repeat(matcher.begin[index] - (ends - sizes), sizes) + np.arange(sizes.sum())
    ]
    offsets = np.append(0, ends)[np.append(0, np.cumsum(counts, dtype=np.int64))]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, *, text="text") -> DataFrame:
    """``docs`` with the column ``text`` replaced by ``ids``.

    Ids equal those of the model's own encoder: a leading blank is added to a
    non-empty text, neighbours merge by score, leftmost first, and characters
    without a piece become bytes.  Null and empty texts have no ids.  A column
    called ``ids`` is replaced.  No shuffle.  A task holds one Arrow batch, the
    words it remembers and the index of new words of about 400,000 characters,
    or of one longer word; nothing is kept when it ends.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rest = [c for c in docs.columns if c not in (text, "ids")]
    slim = docs.select(text, *rest)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column(0)), 0).to_pylist()
            for low, high in _groups(lengths, _BATCH_CHARS):
                part = batch.slice(low, high - low)
                texts = [t or "" for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], encode_batch(matcher, texts)], [*rest, "ids"]
                )

    schema = slim.select(*rest, F.lit(None).cast("array<int>").alias("ids")).schema
    return slim.mapInArrow(rows, schema)


def decode_ids(table: list[bytes], ids: list[int] | None) -> str:
    """Text of some ids: bytes joined, marks as blanks, without the added one."""
    joined = b"".join([table[i] for i in ids or ()]).decode("utf-8", "replace")
    return joined[1:] if joined.startswith(" ") else joined


def byte_table(vocabulary: Vocabulary) -> list[bytes]:
    """Bytes that each id stands for; nothing for control ids."""
    table = [
        p.replace(MARK, " ").encode() if ok else b""
        for p, ok in zip(vocabulary.pieces, vocabulary.normal)
    ]
    for value, i in enumerate(vocabulary.byte_ids):
        table[i] = bytes([value])
    return table


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, *, ids="ids") -> DataFrame:
    """``encoded`` with a column ``decoded``, the text of its ids; null ids as none."""
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(byte_table(vocabulary))
    rest = [c for c in encoded.columns if c != "decoded"]
    slim = encoded.select(*rest)
    place = rest.index(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            bounds = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            texts = [
                decode_ids(shared.value, values[i:j].tolist())
                for i, j in zip(bounds[:-1], bounds[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*rest, "decoded"]
            )

    schema = slim.select("*", F.lit(None).cast("string").alias("decoded")).schema
    return slim.mapInArrow(rows, schema)
