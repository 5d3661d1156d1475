"""Words, hashes and sorted fingerprint sets as numpy arrays, for use inside Spark tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Units hashed at a time.
CACHED = 1 << 15
# Odd multipliers of a 64-bit mixing function.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    out = values ^ (values >> np.uint64(30))
    out *= MIX[0]
    out ^= out >> np.uint64(27)
    out *= MIX[1]
    out ^= out >> np.uint64(31)
    return out


def slices(batch: pa.RecordBatch | pa.Table, column: str, most_bytes: int) -> Iterator[pa.Table]:
    """Cut rows into runs whose ``column`` holds about ``most_bytes``; a longer value makes a run of its own."""
    table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    sizes = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < table.num_rows:
        limit = (ends[start - 1] if start else 0) + most_bytes
        stop = max(int(np.searchsorted(ends, limit, side="right")), start + 1)
        yield table.slice(start, stop - start)
        start = stop


def whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in order, and where each text's words begin.

    Null texts have no words.  The second value has one entry more than there are texts.
    """
    lists = pc.ascii_split_whitespace(texts)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values = lists.flatten()
    real = pc.greater(pc.binary_length(values), 0)
    if not pc.all(real, min_count=0).as_py():
        keep = real.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths = np.bincount(owner[keep], minlength=len(lengths))
        values = values.filter(real)
    return values, np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes; depends on nothing else."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.uint64)
    lengths = pc.binary_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)
    _, offsets, data = strings.buffers()
    first = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + n].astype(np.int64)
    # The strings lie one after the other, without gaps.
    data = np.frombuffer(data or b"", np.uint8)[first[0] : first[0] + lengths.sum()]
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    powers = np.ones(int(lengths.max()) + 1, np.uint64)
    powers[1:] = MIX[2]
    powers = np.cumprod(powers, dtype=np.uint64)
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
    ends = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    total = ends[starts + lengths] - ends[starts]
    return mixed(total * MIX[0] + lengths.astype(np.uint64))


def coded_words(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each word in the list of distinct words, and that list."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def word_hashes(values: pa.Array) -> np.ndarray:
    codes, distinct = coded_words(values)
    return string_hashes(distinct)[codes] if len(distinct) else np.zeros(0, np.uint64)


def window_hashes(units: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` units; one entry per run."""
    return all_window_hashes(units, width)[0]


def all_window_hashes(units: np.ndarray, *widths: int) -> list[np.ndarray]:
    """Hashes of runs of several widths; worked off in pieces that stay in the processor's cache."""
    out = [np.empty(max(len(units) - width + 1, 0), np.uint64) for width in widths]
    for at in range(0, max(len(units), 1), CACHED):
        piece = units[at : at + CACHED + max(widths) - 1]
        for whole_part, part in zip(out, piece_hashes(piece, widths)):
            part = part[:CACHED]
            whole_part[at : at + len(part)] = part
    return out


def piece_hashes(units: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """Runs of any width, put together from runs of 1, 2, 4 and so on units."""
    found: list[np.ndarray | None] = [None] * len(widths)
    done = [0] * len(widths)
    level, size = units, 1
    while True:
        for k, width in enumerate(widths):
            n = max(len(units) - width + 1, 0)
            if width & size:
                piece = level[done[k] : done[k] + n]
                if found[k] is None:
                    found[k] = piece.copy()
                else:
                    found[k] *= MIX[2]
                    found[k] += piece
                found[k] ^= found[k] >> np.uint64(29)
                done[k] += size
        if done == list(widths):
            return [mixed(out * MIX[0]) for out in found]
        if len(level) <= size:
            level = level[:0]
        else:
            level = level[:-size] * MIX[1] + level[size:]
            level ^= level >> np.uint64(32)
        size *= 2


def within(bounds: np.ndarray, width: int) -> np.ndarray:
    """Whether a run of ``width`` units from each start lies inside one document."""
    total = int(bounds[-1])
    n = max(total - width + 1, 0)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    return np.arange(n) + width <= ends[:n]


def member(values: np.ndarray, sorted_set: np.ndarray, bits: int = 64) -> np.ndarray:
    """Whether each value of so many bits is in the set; a table of their top bits settles most."""
    found = np.zeros(len(values), bool)
    if not len(sorted_set) or not len(values):
        return found
    top = min(max(len(sorted_set).bit_length() + 3, 12), 22)
    shift = np.uint64(bits - top)
    own = (sorted_set >> shift).astype(np.int64)
    table = np.zeros(1 << top, bool)
    table[own] = True
    place = (values >> shift).astype(np.int64)
    maybe = np.flatnonzero(table[place])
    sizes = np.bincount(own, minlength=1 << top)
    begins = (np.cumsum(sizes) - sizes)[place[maybe]]
    sizes = sizes[place[maybe]]
    step = 0
    while len(maybe):
        found[maybe[sorted_set[begins + step] == values[maybe]]] = True
        step += 1
        more = sizes > step
        maybe, begins, sizes = maybe[more], begins[more], sizes[more]
    return found


def packed(sorted_values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences of as few bytes as the largest one needs."""
    if not len(sorted_values):
        return b""
    steps = np.diff(sorted_values, prepend=np.uint64(0))
    first, rest = steps[:1], steps[1:]
    width = max((int(rest.max()).bit_length() + 7) // 8, 1) if len(rest) else 1
    body = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.astype("<u8").tobytes() + np.ascontiguousarray(body).tobytes()


def unpacked(blob: bytes | None) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    width = blob[0]
    body = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(blob, np.uint8, count=8, offset=1)
    steps[1:, :width] = body
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def covered(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which of ``total`` units lie in a run of ``width`` from one of the starts, each given once."""
    edges = np.zeros(total + 1, np.int32)
    edges[starts] += 1
    edges[starts + width] -= 1
    return np.cumsum(edges[:-1]) > 0


def text_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts in order, and where each text begins; null texts are empty."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; for 64-bit hashes a plain sort is far faster than ``np.unique``."""
    ordered = np.sort(values)
    return ordered[np.append(np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1])]


def dense_ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank, from 0, of each value among the distinct ones, and their number."""
    order = np.argsort(values)
    ordered = values[order]
    ranks = np.empty(len(values), np.int64)
    steps = np.append(np.zeros(min(len(ordered), 1), np.int64), ordered[1:] != ordered[:-1])
    ranks[order] = np.cumsum(steps)
    return ranks, int(steps.sum()) + 1 if len(values) else 0


def repeated(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values that occur more than once."""
    ordered = np.sort(values)
    return distinct(ordered[1:][ordered[1:] == ordered[:-1]])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(task: Task) -> Task:
    """The same task, giving freed memory back to the system at its end: later stages reuse its worker process."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
