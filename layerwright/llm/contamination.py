"""Benchmark decontamination with suffix arrays of the training text.

Every shard of documents (a few megabytes in one task) gets a word-level suffix array; every test suffix is binary-searched
in it down to the window length, and matches are followed to the longest verbatim one.  The array leaves out suffixes that
cannot match: those whose first words do not occur together in any test item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import small_batches, stored, text_bytes
from .words import MIX, distinct, member, mixed, slices, split_words, text_units, tidy, whole

SHARD_BYTES = 4 << 20
# Test text one pass takes along; a larger test set takes more passes.
TEST_BYTES = 16 << 20
HITS = "array<struct<start: int, stop: int>>"
MATCHES = "array<struct<item_id: string, start: int, length: int>>"
HITS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
MATCHES_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
# Bytes of words are digits, letters and everything beyond ASCII; A-Z are lower-cased.
WORD_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8
)


def test_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of letters, digits and non-ASCII characters, and where each text's words begin."""
    data, bounds = text_units(texts)
    plain = pa.StringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(WORD_BYTES[data])
    )
    return split_words(plain)


class TestSuffixes:
    """The windows of a block of test items over the numbered test vocabulary."""

    def __init__(self, item_ids: list, texts: list[str | None], window: int) -> None:
        values, bounds = test_words(pa.array(texts, pa.string()))
        self.vocabulary = values.unique()
        codes = pc.index_in(values, self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.item_ids = item_ids
        self.bits = max(int(len(self.vocabulary)).bit_length(), 1)
        self.sequence = np.zeros(len(codes) + len(item_ids) + window, np.int64)
        owner = np.repeat(np.arange(len(item_ids)), np.diff(bounds))
        self.sequence[np.arange(len(codes)) + owner] = codes
        starts, widths, items = [], [], []
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            width = min(int(b - a), window)
            if width:
                count = int(b - a) - width + 1
                starts.append(np.arange(a, a + count) + i)
                widths.append(np.full(count, width))
                items.append(np.full(count, i))
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.starts, self.widths, self.items = joined(starts), joined(widths), joined(items)
        self.depth = int(self.widths.max()) if len(self.widths) else 0
        self.per_key = max(min(63 // self.bits, self.depth), 1)
        self.least = min(self.per_key, int(self.widths.min())) if len(self.widths) else 0
        heads = self.packed(self.sequence, self.starts, 0, self.least)
        self.heads = distinct(mixed(heads.astype(np.uint64) * MIX[2]))

    def packed(self, sequence: np.ndarray, starts: np.ndarray, first: int, count: int) -> np.ndarray:
        """Words ``first`` to ``first + count`` of each suffix as one number."""
        key = np.zeros(len(starts), np.int64)
        for k in range(first, first + count):
            key = (key << self.bits) | sequence[starts + k]
        return key

    def suffix_array(self, sequence: np.ndarray) -> np.ndarray:
        """Places of ``sequence`` that can begin a match, sorted by their words down to the window length."""
        places = np.flatnonzero(sequence)
        heads = mixed(self.packed(sequence, places, 0, self.least).astype(np.uint64) * MIX[2])
        places = places[member(heads, self.heads)]
        keys = [
            self.packed(sequence, places, k, min(self.per_key, self.depth - k))
            for k in range(0, self.depth, self.per_key)
        ]
        return places[np.lexsort(keys[::-1])] if keys else places

    def search(self, sequence: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window the range of ``array`` whose suffixes begin with it."""
        wanted = self.sequence[self.starts[:, None] + np.arange(self.depth)]
        inside = np.arange(self.depth) < self.widths[:, None]
        ends = []
        for after_equal in (False, True):
            low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(array))
            while (low < high).any():
                middle = (low + high) // 2
                at = array[np.minimum(middle, len(array) - 1)]
                differ = np.where(inside, sequence[at[:, None] + np.arange(self.depth)] - wanted, 0)
                first = (differ != 0).argmax(axis=1)
                sign = differ[np.arange(len(differ)), first]
                right = (sign < 0) | ((sign == 0) & after_equal)
                active = low < high
                low = np.where(active & right, middle + 1, low)
                high = np.where(active & ~right, middle, high)
            ends.append(low)
        return ends[0], ends[1]

    def matches(self, values: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of windows as item, first word, width and length of the verbatim match from there."""
        none = (np.zeros(0, np.int64),) * 4
        if not self.depth or not len(values):
            return none
        coded = values.dictionary_encode()
        known = pc.index_in(coded.dictionary, self.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False) + 1
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        spread = np.arange(len(values)) + owner
        sequence = np.zeros(len(values) + len(bounds) - 1 + self.depth, np.int64)
        sequence[spread] = known[coded.indices.to_numpy(zero_copy_only=False)]
        array = self.suffix_array(sequence)
        if not len(array):
            return none
        low, high = self.search(sequence, array)
        found = high - low
        window = np.repeat(np.arange(len(found)), found)
        place = array[np.arange(int(found.sum())) - np.repeat(np.cumsum(found) - found - low, found)]
        length = self.widths[window].copy()
        going = np.arange(len(window))
        while len(going):
            here, there = place[going] + length[going], self.starts[window[going]] + length[going]
            here, there = np.minimum(here, len(sequence) - 1), np.minimum(there, len(self.sequence) - 1)
            same = (sequence[here] == self.sequence[there]) & (self.sequence[there] > 0)
            going = going[same]
            length[going] += 1
        back = np.searchsorted(spread, place)
        return self.items[window], back, self.widths[window], length


def searched(rows: DataFrame, tests: TestSuffixes, keep_text: bool = True) -> DataFrame:
    """Rows with ``text``, and beside them ``n_words, hits, matches`` for one block of test items."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                values, bounds = test_words(whole(part["text"]))
                item, start, width, length = tests.matches(values, bounds)
                hits: list[list] = [[] for _ in range(part.num_rows)]
                matches: list[list] = [[] for _ in range(part.num_rows)]
                owner = np.searchsorted(bounds, start, side="right") - 1
                order = np.lexsort((start, -length, item, owner))
                owner, item, start, width, length = (x[order] for x in (owner, item, start, width, length))
                heads = np.flatnonzero(np.diff(owner, prepend=-1))
                for a, b in zip(heads, np.append(heads[1:], len(owner))):
                    doc = owner[a]
                    hits[doc] = joined_runs(start[a:b] - bounds[doc], start[a:b] - bounds[doc] + width[a:b])
                    firsts = a + np.flatnonzero(np.diff(item[a:b], prepend=-1))
                    for k in firsts:
                        place = int(start[k] - bounds[doc])
                        named = tests.item_ids[item[k]]
                        matches[doc].append({"item_id": named, "start": place, "length": int(length[k])})
                columns = {name: part[name] for name in part.column_names if keep_text or name != "text"}
                columns["n_words"] = pa.array(np.diff(bounds), pa.int64())
                columns["hits"] = pa.array(hits, HITS_ARROW)
                columns["matches"] = pa.array(matches, MATCHES_ARROW)
                yield from pa.table(columns).to_batches()

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if keep_text or f.name != "text"]
    return rows.mapInArrow(tidy(scan), ", ".join([*kinds, "n_words bigint", f"hits {HITS}", f"matches {MATCHES}"]))


def joined_runs(starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    """Maximal runs of the places covered by spans; spans that touch are one run."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    heads = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    tails = np.append(heads[1:], len(starts)) - 1
    return [{"start": x, "stop": y} for x, y in zip(starts[heads].tolist(), reach[tails].tolist())]


def in_passes(rows: DataFrame, items: DataFrame, passes: int, window: int) -> DataFrame:
    """``searched`` for test items of several blocks, one after the other, so that one block at a time is in memory.

    Rows are stored once under a number; the first pass writes what it finds for all rows, each later one for those
    that it hits, without texts, and a row's finds are merged at the end.
    """
    spark = rows.sparkSession
    rows, _ = stored(rows.withColumn("row_number", F.monotonically_increasing_id()), "judged")
    finds = scratch_path(spark, "finds")
    texts = rows.select("row_number", "text")
    for n in range(passes):
        found = searched(texts, collected(items, passes, n, window), keep_text=False)
        if n:
            found = found.where("size(hits) > 0")
        found.write.mode("append").parquet(finds)

    @F.arrow_udf(HITS)
    def merged(starts: pa.Array, stops: pa.Array) -> pa.Array:
        pairs = zip(starts.to_pylist(), stops.to_pylist())
        return pa.array([joined_runs(np.array(a), np.array(b)) if a else [] for a, b in pairs], HITS_ARROW)

    found = spark.read.schema(f"row_number bigint, n_words bigint, hits {HITS}, matches {MATCHES}").parquet(finds)
    found = found.groupBy("row_number").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    )
    found = found.withColumn("hits", merged(F.col("hits.start"), F.col("hits.stop")))
    return rows.join(found, "row_number").drop("row_number")


def collected(items: DataFrame, passes: int, n: int, window: int) -> TestSuffixes:
    """The windows of block ``n`` of the test items."""
    block = items.where(F.expr(f"pmod(xxhash64(item_id, text), {passes}) = {n}")).collect()
    return TestSuffixes([r.item_id for r in block], [r.text for r in block], window)


def decontaminated(
    documents: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Words of documents that lie in an occurrence of a window of a test item.

    Words are runs of anything but ASCII characters other than letters and digits, lower-cased in A-Z.  A window is
    ``window`` consecutive words of an item, or the whole item if it has fewer, but not none.  Needs ``doc_id, text``
    and ``item_id, text``; of other columns, whatever their names, only those in ``carry`` are kept.  Returns one row
    per row: ``doc_id, n_words, hits`` (maximal runs of hit words as ``start, stop``), ``matches`` (per item that
    occurs, its longest verbatim match as ``item_id, start, length``; the first of equally long ones), ``n_hit`` and
    ``contaminated`` (some word is hit, and hits are ``percent`` of the words or more).  Null texts have no words; null
    ids are allowed on both sides; repeated rows are judged each, repeated items once; empty tables give no rows, or no
    hits.
    """
    spark = documents.sparkSession
    small_batches(spark)
    kept = [f"carried_{k}" for k in range(len(carry))]
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    passes = max(-(-text_bytes(items) // TEST_BYTES), 1)
    rows = documents.select("doc_id", "text", *(F.col(c).alias(k) for c, k in zip(carry, kept)))
    if passes == 1:
        rows = searched(rows, collected(items, 1, 0, window))
    else:
        rows = in_passes(rows, items, passes, window)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    result = rows.select(
        "doc_id",
        *(F.col(k).alias(c) for c, k in zip(carry, kept)),
        "n_words",
        "hits",
        "matches",
        n_hit.alias("n_hit"),
    )
    return result.withColumn("contaminated", F.expr(f"n_hit > 0 AND 100 * n_hit >= {percent} * n_words"))
