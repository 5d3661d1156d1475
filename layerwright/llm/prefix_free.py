"""Suffix-array dedup of bytes by prefix-free parsing.

A rolling hash picks trigger strings; they cut a text into overlapping phrases, each from one trigger to the end of the
next.  The dictionary of distinct phrases and the parse, the sequence of phrase numbers, are sorted by suffix
separately; together they give the order of all suffixes of the text, at the cost of the dictionary and not of the
copies in it.  Suffixes that share their first ``width`` bytes stand side by side in that order.

Over a corpus, chunks of documents are parsed.  What can repeat is found first by exchanging trigger hashes between
chunks: each string of ``width`` bytes is named by the least hash of the strings of ``GRAM`` bytes in it, which equal
strings share.  Neighbouring strings of one name form a run; where all runs of a name are alike, as inside long repeats,
the name settles them.  Only strings of other names that occur again are compared by hash between chunks, and only strings
of names that occur again within a chunk are sorted there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import match_shared, resolve_repeats
from .words import all_window_hashes, covered, dense_ranks, distinct, member, mixed, repeated, runs, text_units, whole, window_hashes, within

GRAM = 32
NAME_BITS = 40
CHUNK_BYTES = 4 << 20
# Triggers of the parse: strings of so many bytes, one in so many.
TRIGGER, APART = 16, 32
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Rank, from 1, of the suffix at each position that stops at ``ends``, by its first ``depth`` symbols at least.

    Symbols of so many bits, from 1.  The first ranks come from as many symbols as fit a number; prefix doubling then
    ranks pairs of ranks, until all differ or the longest suffix is covered.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    place, reach = np.arange(n), max(62 // bits, 1)
    left = ends - place
    key = np.zeros(n, np.int64)
    for k in range(reach):
        key <<= bits
        if k < n:
            key[: n - k] |= np.where(left[: n - k] > k, symbols[k:], 0)
    ranks, count = dense_ranks(key)
    ranks += 1
    longest = min(int(left.max()), depth)
    while reach < longest and count < n:
        after = np.zeros(n, np.int64)
        after[: max(n - reach, 0)] = np.where(left[: max(n - reach, 0)] > reach, ranks[reach:], 0)
        ranks, count = dense_ranks((ranks << 32) | after)
        ranks += 1
        reach *= 2
    return ranks


def parse(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases as starts, ends (past the closing trigger) and the text each belongs to."""
    hashes = window_hashes(BYTES[data], TRIGGER)
    cut = within(bounds, TRIGGER) & (hashes % np.uint64(APART) == 0)
    filled = np.flatnonzero(np.diff(bounds))
    starts = np.union1d(np.flatnonzero(cut), bounds[:-1][filled])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    nexts = np.append(starts[1:], len(data))
    last = np.append(owner[1:] != owner[:-1], True) if len(starts) else np.zeros(0, bool)
    ends = np.where(last, bounds[owner + 1], nexts + TRIGGER)
    return starts, ends, owner


def corpus_order(data: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``data`` in the lexicographic order of their suffixes, each ending with its own text.

    Suffixes that share their first ``depth`` bytes stand together, but may be out of order beyond.

    Suffixes are ordered by what is left of their phrase, then by the rank of the rest of the parse.  No phrase end
    occurs inside another phrase, so the first key decides unless it is equal.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    starts, ends, owner = parse(data, bounds)
    lengths = ends - starts
    # Dictionary: distinct phrases; a phrase that ends its text differs from one that goes on.
    closing = np.append(owner[1:] != owner[:-1], True)
    texts = {}
    numbers = np.empty(len(starts), np.int64)
    raw = data.tobytes()
    firsts = []
    for i, (a, b, last) in enumerate(zip(starts.tolist(), ends.tolist(), closing.tolist())):
        key = (raw[a:b], last)
        number = texts.get(key)
        if number is None:
            number = texts[key] = len(firsts)
            firsts.append(i)
        numbers[i] = number
    firsts = np.array(firsts)
    sizes = lengths[firsts]
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    within_phrase = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    dictionary = data[np.repeat(starts[firsts], sizes) + within_phrase].astype(np.int64) + 1
    suffixes = suffix_ranks(dictionary, np.repeat(begins + sizes, sizes), 9, depth)
    # Parse: phrase numbers in dictionary order, sorted by suffix within each text.
    ordered, count = dense_ranks(suffixes[begins] * 2 + closing[firsts])
    sequence = ordered[numbers] + 1
    text_ends = np.append(np.flatnonzero(closing) + 1, len(starts))
    text_ends = text_ends[np.searchsorted(text_ends, np.arange(len(starts)), side="right")]
    ranks = suffix_ranks(sequence, text_ends, max(count.bit_length(), 1), depth)
    # Every position: its phrase, what is left of it, and the rank of the phrases after.
    phrase = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(data)))
    left = suffixes[begins[numbers[phrase]] + np.arange(len(data)) - starts[phrase]]
    rest = np.where(closing[phrase], 0, ranks[np.minimum(phrase + 1, len(ranks) - 1)])
    return np.lexsort((rest, left))


def suffix_dedup(documents: DataFrame, width: int = 50, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Remove every byte covered by a string of ``width`` bytes that also starts in a document with a smaller id.

    Texts are UTF-8 bytes; strings lie in one document, may overlap and are judged on the input, not on what is left.
    Needs ``doc_id`` (integer) and ``text``; other columns, whatever their names, are not read.  Returns one row per
    row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and ``kept`` (the remaining bytes; a cut may
    split a character, so not a string).  Null texts are empty; a document with a null id keeps all bytes and is no
    reference; rows with equal ids do not remove each other's bytes; an empty table gives an empty result.
    """
    if width < GRAM + 1:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    grams = width - GRAM + 1
    shift = np.uint64(64 - NAME_BITS)

    def named(rows: pa.Table, *more: int) -> tuple[np.ndarray, ...]:
        """Bytes, bounds, the name of the string at each position, whether it lies in one document with an id, and the
        hashes of runs of ``more`` bytes."""
        data, bounds = text_units(whole(rows["text"]))
        least, *hashes = all_window_hashes(BYTES[data], GRAM, *more)
        least >>= shift
        done = 1
        while done < grams and len(least):
            step = min(done, grams - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        inside = within(bounds, width) & np.repeat(rows["doc_id"].is_valid().to_numpy(), np.diff(bounds))[: len(least)]
        return data, bounds, least, inside, *hashes

    def turns(names: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """One position for each run of equal names."""
        changed = np.ones(len(names), bool)
        changed[1:] = (names[1:] != names[:-1]) | (inside[1:] & ~inside[:-1])
        return np.flatnonzero(changed & inside)

    def spread(known: np.ndarray, at: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """What is known of the first position of each run of names, for all its positions."""
        sizes = np.diff(at, append=len(known))
        out = np.zeros(len(known), bool)
        if len(at):
            out[at[0] :] = np.repeat(known[at], sizes)
        return out & inside

    def fingerprints(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, _, names, inside, full = named(rows, width)
        at = turns(names, inside)
        # Beside each name a hash of all strings of its run; two different ones if its runs differ.
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(np.where(inside, mixed(full), 0), dtype=np.uint64)))
        beside = mixed(total[np.append(at[1:], len(names))] - total[at] if len(at) else total[:0])
        beside = (beside >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((beside, names[at]))
        found, beside = names[at][order], beside[order]
        new = np.append(np.ones(min(len(found), 1), bool), (found[1:] != found[:-1]) | (beside[1:] != beside[:-1]))
        return beside[new], found[new]

    def windows(rows: pa.Table, live: np.ndarray) -> np.ndarray:
        _, _, names, inside, full = named(rows, width)
        at = turns(names, inside)
        known = np.zeros(len(names), bool)
        known[at] = member(names[at], live, NAME_BITS)
        return distinct(full[spread(known, at, inside)])

    def resolve(rows: pa.Table, earlier: np.ndarray, settled: np.ndarray) -> pa.Table:
        data, bounds, names, inside, full = named(rows, width)
        cut = member(full, earlier) & inside
        owner = np.repeat(rows["doc_id"].fill_null(0).to_numpy(), np.diff(bounds))
        at = turns(names, inside)
        known = np.zeros(len(names), bool)
        known[at] = member(names[at], settled, NAME_BITS)
        cut |= spread(known, at, inside)
        row = np.repeat(np.arange(rows.num_rows, dtype=np.uint64), np.diff(bounds))
        pairs = distinct((names[at] << np.uint64(64 - NAME_BITS)) | row[at])
        known = np.zeros(len(names), bool)
        known[at] = member(names[at], repeated(pairs >> np.uint64(64 - NAME_BITS)), NAME_BITS)
        again = spread(known, at, inside)
        begins, ends = runs(again)
        sizes = ends + width - 1 - begins
        edges = np.concatenate(([0], np.cumsum(sizes)))
        origin = np.arange(int(edges[-1])) - np.repeat(edges[:-1] - begins, sizes)
        order = origin[corpus_order(data[origin], edges, width)]
        order = order[again[np.minimum(order, len(again) - 1)] & (order < len(again))] if len(again) else order
        # Regions may overlap: a position then stands in the order twice.
        key, ids = full[order], owner[order]
        group = np.cumsum(np.concatenate((np.zeros(min(len(key), 1), np.int64), (key[1:] != key[:-1]).astype(np.int64))))
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        if len(key):
            smallest = np.minimum.reduceat(ids, heads)[group]
            cut[order[ids > smallest]] = True
        gone = covered(np.flatnonzero(cut), width, len(data))
        return cut_rows(rows, data, bounds, gone)

    return resolve_repeats(
        documents, fingerprints, windows, resolve, SCHEMA, match=match_shared, bits=NAME_BITS, chunk_bytes=chunk_bytes
    )


def cut_rows(rows: pa.Table, data: np.ndarray, bounds: np.ndarray, gone: np.ndarray) -> pa.Table:
    """Result rows for the bytes left."""
    total = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    first[heads] = gone[heads]
    opened = np.concatenate(([0], np.cumsum(first, dtype=np.int64)))
    left = data[~gone].tobytes()
    at = bounds - total[bounds]
    return pa.table(
        {
            "doc_id": rows["doc_id"].cast(pa.int64()),
            "n_bytes": pa.array(np.diff(bounds), pa.int64()),
            "n_removed": pa.array(np.diff(total[bounds]), pa.int64()),
            "n_spans": pa.array(np.diff(opened[bounds]), pa.int64()),
            "kept": pa.array([left[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
        }
    )
