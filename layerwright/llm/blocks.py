"""Substring dedup by fixed-block anchors.

Each document's non-overlapping blocks of ``block`` words are indexed; every rolling window of ``block`` words of every
document probes that index.  A repeat of ``window`` words holds a whole block of the earlier document as long as
``window >= 2 * block - 1``, so no repeat is missed.  Hits are then extended: all windows around a hit are compared, and
neighbouring windows that occur earlier join to the maximal exact repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .repeats import CHUNK_BYTES, resolve_repeats
from .words import all_window_hashes, covered, distinct, member, repeated, runs, split_words, whole, within, word_hashes

ANCHOR_BITS = 40
SCHEMA = "doc_id long, n_words long, n_removed long, kept string, text string"


def substring_dedup(
    documents: DataFrame,
    window: int = 50,
    block: int = 25,
    chunk_bytes: int = CHUNK_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Remove every word covered by a run of ``window`` words that also starts in a document with a smaller id.

    Words are runs of anything but ASCII white space, unchanged.  Runs are judged on the input, not on what is left,
    and lie in one document.  Needs ``doc_id`` (integer) and ``text``; of other columns, whatever their names, only those
    in ``carry`` are kept, at the end.  Returns one row per row: ``doc_id, n_words, n_removed``, ``kept`` (words left,
    joined by one space) and ``text``: the input where nothing was removed, else what is left between removed runs in
    its original spacing.
    Null texts have no words, an empty ``kept`` and a null ``text``; a document with a null id keeps all words and is
    no reference; rows with equal ids do not remove each other's words; an empty table gives an empty result.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    shift = np.uint64(64 - ANCHOR_BITS)

    def rolled(rows: pa.Table, *more: int) -> tuple:
        """Words, bounds, block hashes, which blocks lie in one document with an id, and hashes of ``more`` words."""
        values, bounds = split_words(whole(rows["text"]))
        hashes = word_hashes(values)
        named = rows["doc_id"].is_valid().to_numpy()
        inside = within(bounds, block) & np.repeat(named, np.diff(bounds))[: max(len(hashes) - block + 1, 0)]
        probes, *longer = all_window_hashes(hashes, block, *more)
        return values, bounds, probes >> shift, inside, *longer

    def anchored(bounds: np.ndarray, inside: np.ndarray) -> np.ndarray:
        place = np.arange(len(inside)) - np.repeat(bounds[:-1], np.diff(bounds))[: len(inside)]
        return inside & (place % block == 0)

    def fingerprints(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, bounds, probes, inside = rolled(rows)
        return distinct(probes[anchored(bounds, inside)]), distinct(probes[inside])

    def around(live: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a live block."""
        inside = within(bounds, window)
        count = np.concatenate(([0], np.cumsum(live, dtype=np.int64)))
        starts = np.arange(len(inside))
        return starts[inside & (count[starts + window - block + 1] > count[starts])]

    def windows(rows: pa.Table, live: np.ndarray) -> np.ndarray:
        _, bounds, probes, inside, full = rolled(rows, window)
        return distinct(full[around(inside & member(probes, live, ANCHOR_BITS), bounds)])

    def resolve(rows: pa.Table, earlier: np.ndarray, settled: np.ndarray) -> pa.Table:
        values, bounds, probes, inside, full = rolled(rows, window)
        ids = rows["doc_id"].fill_null(0).to_numpy()
        lengths = np.diff(bounds)
        named = np.repeat(rows["doc_id"].is_valid().to_numpy(), lengths)[: len(full)]
        cut = member(full, earlier) & within(bounds, window) & named
        # Within the chunk: blocks that occur again, then the windows around them.
        again = np.intersect1d(repeated(probes[inside]), distinct(probes[anchored(bounds, inside)]), assume_unique=True)
        starts = around(inside & member(probes, again, ANCHOR_BITS), bounds)
        owner = np.repeat(ids, lengths)[starts]
        order = np.lexsort((owner, full[starts]))
        key, owner = full[starts][order], owner[order]
        first = np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1]))
        smallest = owner[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))] if len(key) else owner
        cut[starts[order][owner > smallest]] = True
        gone = covered(np.flatnonzero(cut), window, len(values))
        result = cut_rows(rows, values, bounds, gone)
        for k in range(len(carry)):
            result = result.append_column(f"carried_{k}", rows[f"carried_{k}"])
        return result

    kinds = (documents.schema[c].dataType.simpleString() for c in carry)
    schema = SCHEMA + "".join(f", carried_{k} {kind}" for k, kind in enumerate(kinds))
    result = resolve_repeats(
        documents, fingerprints, windows, resolve, schema, bits=ANCHOR_BITS, chunk_bytes=chunk_bytes, carry=carry
    )
    return result.withColumnsRenamed({f"carried_{k}": c for k, c in enumerate(carry)})


def cut_rows(rows: pa.Table, values: pa.Array, bounds: np.ndarray, gone: np.ndarray) -> pa.Table:
    """Result rows for the words left."""
    total = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
    n_removed = total[bounds[1:]] - total[bounds[:-1]]
    left = rows["text"].to_pylist()
    for i in np.flatnonzero(n_removed):
        a, b = bounds[i], bounds[i + 1]
        left[i] = " ".join(between(left[i], values[a:b].to_pylist(), gone[a:b]))
    offsets = pa.array(bounds - total[bounds], pa.int32())
    kept = pc.binary_join(pa.ListArray.from_arrays(offsets, values.filter(pa.array(~gone))), " ")
    return pa.table(
        {
            "doc_id": rows["doc_id"].cast(pa.int64()),
            "n_words": pa.array(np.diff(bounds), pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": kept,
            "text": pa.array(left, pa.string()),
        }
    )


def between(text: str, words: list[str], gone: np.ndarray) -> list[str]:
    """What stands between removed runs, from the first to the last word of each kept run."""
    places, at = [], 0
    for word in words:
        at = text.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    return [text[places[a][0] : places[b - 1][1]] for a, b in zip(*runs(~gone))]
