"""Harmonic packing of tokenised documents into sequences of fixed length.

A document's full sequences are cut off first.  The length of the rest falls into a class of reciprocal capacity: class k
takes lengths in ``(capacity / (k + 1), capacity / k]``, and a bin of class k holds k of them, whatever else arrives.  What
k pieces leave of their bin is filled with whole small pieces (those beyond the last class), then by cutting one
document, the filler, whose next tokens go into the next gap.  Every bin thus holds a whole rest and cuts one piece at
most.  Every worker fills its own bins; what is left open at its end is joined without a gap, and the part shorter than a
sequence is cut at powers of two.
"""

from __future__ import annotations

import functools
import json
import re
from collections import deque
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tables import small_batches
from .words import coded_words, slices, split_words, tidy, whole

SLICE_BYTES = 6 << 20
# Distinct words whose tokens a worker remembers.
REMEMBERED = 1_000_000
# Classes; shorter rests are small pieces, which fill gaps.
CLASSES = 64
# Fixed value: the end of a tokenizer's cutting pattern that takes letters, digits and other signs apart.
LETTERS_APART = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
Piece = tuple[int | None, int, int, bytes, int]


def folded(texts: pa.Array, keep: str) -> pa.Array:
    """Texts of the same tokens with fewer different words, for a tokenizer that lower-cases and parts letters from signs.

    Letters A-Z become small and a space parts a letter from a full stop or the like behind it.  Texts that match ``keep``
    stay as they are.
    """
    short = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,;:!?])", r"\1 \2")
    return pc.if_else(pc.match_substring_regex(texts, keep), texts, short)


def not_folded(tokenizer_json: str) -> str | None:
    """A pattern of the texts that ``folded`` could give other tokens; None if that holds for all.

    The tokenizer must lower-case and cut letters from all other signs.  Then only combining marks, which may join with a
    small letter but not with its capital, and tokens that are looked for before lower-casing stand in the way.
    """
    parts = json.loads(tokenizer_json)
    first, cuts = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}
    lowers = {"type": "Lowercase"} in first.get("normalizers", [first])
    rule = next((c for c in cuts.get("pretokenizers", [cuts]) if c.get("type") == "Split"), {})
    if not (lowers and rule.get("pattern", {}).get("Regex", "").endswith(LETTERS_APART)):
        return None
    whole_tokens = (re.escape(t["content"]) for t in parts.get("added_tokens", []))
    return "(?i)" + "|".join([r"[\x{0300}-\x{036f}]", *whole_tokens])


@functools.lru_cache(maxsize=1)
def word_tokens(tokenizer_json: str) -> WordTokens:
    """The words a Python worker remembers from task to task; losing them costs time only."""
    return WordTokens(tokenizer_json)


class WordTokens:
    """Token ids by word; words never share a token, as the tokenizer drops the white space between them."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.keeps = not_folded(tokenizer_json)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.lengths, self.ids, self.used = np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0
        self.begins = np.zeros(1024, np.int64)

    def keep(self, words: list[str]) -> None:
        """Forget all but these words."""
        words = [w for w in words if w in self.number]
        number = np.array([self.number[w] for w in words], np.int64)
        lengths, begins, ids = self.lengths[number], self.begins[number], self.ids
        self.forget()
        self.number = dict(zip(words, range(len(words))))
        edges = np.concatenate(([0], np.cumsum(lengths)))
        self.lengths, self.begins, self.used = lengths, edges[:-1], int(edges[-1])
        self.ids = ids[np.arange(self.used) - np.repeat(edges[:-1] - begins, lengths)]

    def learn(self, words: list[str]) -> None:
        if len(self.number) + len(words) > REMEMBERED:
            self.keep(words)
        new = [w for w in words if w not in self.number]
        if not new:
            return
        # One text of all new words; a token belongs to the word that holds its first character.
        found = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        flat = np.array(found.ids, np.uint32)
        starts = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(flat))
        edges = np.cumsum([len(w) + 1 for w in new])
        lengths = np.bincount(np.searchsorted(edges, starts, side="right"), minlength=len(new))
        known = len(self.number)
        self.lengths = roomy(self.lengths, known + len(new))
        self.begins = roomy(self.begins, known + len(new))
        self.ids = roomy(self.ids, self.used + len(flat))
        self.lengths[known : known + len(new)] = lengths
        self.begins[known : known + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.number.update(zip(new, range(known, known + len(new))))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and where each text's ids begin."""
        values, bounds = split_words(texts if self.keeps is None else folded(texts, self.keeps))
        codes, distinct = coded_words(values)
        words = distinct.to_pylist()
        self.learn(words)
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[codes] if words else codes[:0]
        sizes = self.lengths[number]
        edges = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.arange(int(edges[-1])) - np.repeat(edges[:-1] - self.begins[number], sizes)]
        ends = edges[bounds] + np.arange(len(bounds))
        out = np.full(int(ends[-1]), end, np.uint32)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(edges[bounds]))
        out[np.arange(len(ids)) + owner] = ids
        return out, ends


def roomy(values: np.ndarray, size: int) -> np.ndarray:
    """The same values in an array of at least ``size``."""
    if size <= len(values):
        return values
    return np.concatenate((values, np.zeros(max(size - len(values), len(values)), values.dtype)))


def cut(piece: Piece, size: int) -> tuple[Piece, Piece | None]:
    """The first ``size`` tokens of a piece, and what is left of it."""
    doc_id, start, length, ids, total = piece
    if length <= size:
        return piece, None
    return (doc_id, start, size, ids[: 4 * size], total), (doc_id, start + size, length - size, ids[4 * size :], total)


class Bins:
    """The open bins of one worker.

    At most k - 1 pieces wait in class k, small pieces for one sequence, and one filler, so memory does not grow.
    """

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.waiting: dict[int, list[Piece]] = {}
        self.small: deque[Piece] = deque()
        self.small_tokens = 0
        self.filler: Piece | None = None
        # A bin with a gap that nothing could fill yet, and the size of the gap.
        self.gapped: list[Piece] = []
        self.gap = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append((*piece, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total = len(ids)
        rest = total - total % self.capacity
        for start in range(0, rest, self.capacity):
            self.close([(doc_id, start, self.capacity, ids[start : start + self.capacity].tobytes(), total)])
        if rest == total:
            return
        piece = (doc_id, rest, total - rest, ids[rest:].tobytes(), total)
        k = self.capacity // piece[2]
        if k > CLASSES:
            self.add_small(piece)
        elif self.gapped:
            self.filler = piece
            self.fill(self.gapped, self.gap)
        else:
            same = self.waiting.setdefault(k, [])
            same.append(piece)
            if len(same) == k:
                self.waiting[k] = []
                self.fill(same, self.capacity - sum(p[2] for p in same))

    def add_small(self, piece: Piece) -> None:
        self.small.append(piece)
        self.small_tokens += piece[2]
        if self.gapped:
            self.fill(self.gapped, self.gap)
        elif self.small_tokens >= self.capacity:
            self.fill([], self.capacity)

    def fill(self, pieces: list[Piece], gap: int) -> None:
        """Close a bin once its gap is filled; else keep it until a piece arrives."""
        self.gapped, self.gap = [], 0
        while self.small and self.small[0][2] <= gap:
            piece = self.small.popleft()
            self.small_tokens -= piece[2]
            gap -= piece[2]
            pieces.append(piece)
        while gap:
            filler = self.filler or self.longest()
            if filler is None:
                self.gapped, self.gap = pieces, gap
                return
            piece, self.filler = cut(filler, gap)
            gap -= piece[2]
            pieces.append(piece)
        self.close(pieces)

    def longest(self) -> Piece | None:
        """Take a piece that waits, of the class of the longest ones; a small one if no other waits."""
        k = min((k for k, pieces in self.waiting.items() if pieces), default=None)
        if k is not None:
            return self.waiting[k].pop()
        if not self.small:
            return None
        piece = self.small.popleft()
        self.small_tokens -= piece[2]
        return piece

    def finish(self) -> None:
        """Join all that is open, longest pieces first; the part shorter than a sequence goes into powers of two."""
        rest = [*self.gapped, *self.small, *(p for same in self.waiting.values() for p in same)]
        rest += [self.filler] if self.filler else []
        rest.sort(key=lambda p: p[2])
        self.waiting, self.small, self.small_tokens, self.filler, self.gapped = {}, deque(), 0, None, []
        left = sum(p[2] for p in rest)
        # The shortest come first, from the front of the longest piece, so that none is the end of a document alone.
        short = [1 << j for j in range(self.capacity.bit_length() - 1) if left % self.capacity >> j & 1]
        for size in [*short, *[self.capacity] * (left // self.capacity)]:
            pieces: list[Piece] = []
            while size:
                piece, over = cut(rest.pop(), size)
                size -= piece[2]
                pieces.append(piece)
                if over:
                    rest.append(over)
            self.close(pieces)

    def table(self) -> pa.Table:
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*self.rows)) or [()] * len(names)
        self.rows = []
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def packed_sequences(documents: DataFrame, tokenizer_path: str, capacity: int = 4096, end: int = 2) -> DataFrame:
    """Pieces of tokenised documents and their place in sequences of at most ``capacity`` tokens.

    A document's ids are its text by the tokenizer in ``tokenizer_path`` (a file of the driver), without special tokens,
    then ``end``.  The tokenizer must drop white space and never merge across it.  ``capacity`` is a power of two.
    Needs ``doc_id`` (integer) and ``text``; other columns, whatever their names, are not read.  Returns one row per
    piece: ``doc_id, start`` (ids of its document before it), ``length, ids`` (unsigned 32-bit, little endian),
    ``doc_tokens, sequence_id, offset`` (place in the sequence).  Sequences have no gaps and need no padding: each is
    full or, for a few at the end of a worker, a power of two.  Beyond its full sequences a document makes fewer than two
    pieces on average, but for what a worker's end adds.  Null, empty and blank texts consist of ``end`` alone; null ids are kept; repeated rows are
    documents of their own; an empty table gives an empty result.  Where rests are cut depends on which documents a worker
    gets and in which order.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    small_batches(documents.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_json)
        bins = Bins(capacity, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, edges = tokens.encode(whole(part["text"]), end)
                for doc_id, a, b in zip(part["doc_id"].to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
                    bins.add(doc_id, ids[a:b])
                yield from bins.table().to_batches()
        bins.finish()
        yield from bins.table().to_batches()

    return documents.select("doc_id", "text").mapInArrow(tidy(pack), SCHEMA)
