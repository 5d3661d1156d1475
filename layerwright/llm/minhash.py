"""MinHash near-dedup through a multi-index Hamming join.

A document's signature is ``symbols`` b-bit min-hashes of its word shingles.  The signature is split into chunks; if two
signatures differ in at most ``chunks * (errors + 1) - 1`` places, some chunk differs in at most ``errors``.  Those
errors are enumerated by leaving places out: every chunk yields a key for each way to omit ``errors`` places, and two
chunks within that distance share a key.  So all pairs under the signature distance meet, whatever the documents are.

Pairs are then confirmed on full shingle sets.  Only components are wanted, so copies are not expanded: equal sets form
one class, and the classes that share a key form a group around the smallest of them.  Two classes that share a key are
in that key's group together; equal groups of many keys are one.  A group is compared in its task, large ones in pairs of
blocks, and only the edges of a spanning forest leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .tables import removed, small_batches, stored
from .words import dense_ranks, distinct, mixed, slices, split_words, tidy, whole, window_hashes, word_hashes

SYMBOLS = 64
ERRORS = 1
SLICE_BYTES = 2 << 20
BLOCK = 512
# Ids are marked in 2^24 bits before texts move: 2 MB are broadcast, whatever the number of ids.
BITMAPS = 512
# Fixed value: the size of Spark's bitmaps.
BITMAP_BITS = 1 << 15
# A pair at the similarity limit lies beyond the signature distance less often than this.
MISSED = 1e-6
SEEDS = mixed(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def chunk_count(similarity: float, symbols: int = SYMBOLS, errors: int = ERRORS, missed: float = MISSED) -> int:
    """Fewest chunks whose signature distance covers pairs at ``similarity`` but for a share of ``missed``."""
    differ = 1 - similarity
    for chunks in range(1, symbols // (errors + 1) + 1):
        reach = chunks * (errors + 1)
        tail = sum(comb(symbols, k) * differ**k * similarity ** (symbols - k) for k in range(reach, symbols + 1))
        if tail < missed:
            return chunks
    return symbols // (errors + 1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each begins."""
    values, bounds = split_words(pc.ascii_lower(texts))
    hashes = word_hashes(values)
    rolled = window_hashes(hashes, words)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            sets.append(distinct(rolled[a : b - words + 1]))
        elif b > a:
            sets.append(mixed(window_hashes(hashes[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            sets.append(hashes[:0])
    sizes = np.array([len(s) for s in sets], np.int64)
    joined = np.concatenate(sets) if sets else hashes[:0]
    return joined, np.concatenate(([0], np.cumsum(sizes)))


def folded(values: np.ndarray, bounds: np.ndarray, fold: np.ufunc) -> np.ndarray:
    """``fold`` over each non-empty run, 0 for empty ones."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[filled] = fold.reduceat(values, bounds[:-1][filled])
    return out


def set_marks(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    one = folded(mixed(values ^ SEEDS[0]), bounds, np.add)
    two = folded(mixed(values + SEEDS[1]), bounds, np.add)
    return one.view(np.int64), two.view(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=-1)


def symbol_matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def sorted_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Cut a stream sorted by integer ``columns`` so that no group of equal values is split."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if not table.num_rows:
            continue
        rows = np.stack([table[c].to_numpy() for c in columns], 1)
        same = np.flatnonzero((rows != rows[-1]).any(axis=1))
        cut = int(same[-1]) + 1 if len(same) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held


def signed(documents: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, one, two`` (hashes of the set) and ``symbols``; no symbols for an empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                values, bounds = shingle_sets(whole(rows["text"]), words)
                one, two = set_marks(values, bounds)
                signature = np.empty((rows.num_rows, SYMBOLS), np.uint16)
                for k in range(SYMBOLS):
                    least = folded((values ^ SEEDS[2 * k]) * SEEDS[2 * k + 1], bounds, np.minimum)
                    signature[:, k] = mixed(least) >> np.uint64(48)
                sizes = np.diff(bounds)
                raw = [row.tobytes() if n else None for row, n in zip(signature, sizes)]
                yield pa.record_batch(
                    {
                        "doc_id": whole(rows["doc_id"]).cast(pa.int64()),
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "one": pa.array(one),
                        "two": pa.array(two),
                        "symbols": pa.array(raw, pa.binary()),
                    }
                )

    return documents.select("doc_id", "text").mapInArrow(
        tidy(sign), "doc_id long, n_shingles long, one long, two long, symbols binary"
    )


def keyed(chunks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys of each signature: every chunk with every choice of ``ERRORS`` places left out."""
    edges = np.linspace(0, SYMBOLS, chunks + 1).astype(int)
    choices = []
    for c, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        for out in combinations(range(a, b), min(ERRORS, b - a)):
            choices.append((c, [i for i in range(a, b) if i not in out], out))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = symbol_matrix(batch["symbols"]).astype(np.uint64)
            ids = batch["rep"].to_numpy()
            found = np.empty((len(choices), len(ids)), np.uint64)
            for n, (_, places, _) in enumerate(choices):
                key = np.full(len(ids), np.uint64(n + 1))
                for i in places:
                    key = mixed(key * SEEDS[0] + symbols[:, i])
                found[n] = key
            yield pa.record_batch({"key": found.reshape(-1).view(np.int64), "rep": np.tile(ids, len(choices))})

    return keys


def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts on their way through shuffles, which compress single texts less well."""
    for batch in batches:
        for rows in slices(batch, "text", SLICE_BYTES):
            raw = [text.as_buffer() for text in whole(rows["text"])]
            packed = [pa.compress(text, codec="zstd", asbytes=True) for text in raw]
            sizes = pa.array([text.size for text in raw], pa.int64())
            yield pa.record_batch(
                {
                    "rep": whole(rows["doc_id"]).cast(pa.int64()),
                    "n_bytes": sizes,
                    "packed": pa.array(packed, pa.binary()),
                }
            )


def maybe_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose id may be one of ``ids`` (``rep``): all that are, and some more where hashes meet.

    One bit per hash of an id, in a fixed number of bitmaps; they let more rows pass as they fill up.
    """

    def place(name: str) -> list[Column]:
        mark = F.xxhash64(F.col(name).cast("long"))
        position = F.pmod(F.shiftright(mark, 32), F.lit(BITMAP_BITS)).cast("int")
        return [F.pmod(mark, F.lit(BITMAPS)).alias("bitmap"), position.alias("position")]

    marks = ids.select(*place("rep")).groupBy("bitmap").agg(F.bitmap_construct_agg("position").alias("bits"))
    marked = rows.select("*", *place(column)).join(F.broadcast(marks), "bitmap")
    byte = F.conv(F.hex(F.expr("substring(bits, position DIV 8 + 1, 1)")), 16, 10).cast("int")
    return marked.where(F.getbit(byte, F.expr("position % 8")) == 1).select(*rows.columns)


def class_texts(documents: DataFrame, reps: DataFrame, groups: DataFrame) -> DataFrame:
    """``rep, one, two, symbols`` and the text of the classes in ``groups``, and ``places``, the groups of each.

    Everything meets by document id, so texts move once; an id has at most one place per key.  Texts of no group stay
    where they are, but for a few.  Rows with one id may have several texts, which are paired with all classes of the
    id; who computes the sets keeps the fitting ones.
    """
    texts = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = maybe_in(texts, "doc_id", groups)
    texts = texts.mapInArrow(tidy(compressed), "rep long, n_bytes long, packed binary")
    texts = texts.join(groups.select("rep"), "rep", "left_semi")
    texts = texts.groupBy("rep", "n_bytes", F.xxhash64("packed").alias("h")).agg(F.first("packed").alias("packed"))
    blocks = groups.groupBy("pivot").agg(F.expr(f"CAST(ceil(count(*) / {BLOCK}) AS INT)").alias("blocks"))
    dealt = groups.join(blocks, "pivot").withColumn("own", F.expr("CAST(pmod(xxhash64(rep), blocks) AS INT)"))
    places = dealt.groupBy("rep").agg(F.collect_list(F.struct("pivot", "blocks", "own")).alias("places"))
    placed = reps.select("rep", "one", "two", "symbols").join(places, "rep")
    return texts.join(placed, "rep").drop("h")


def fitting_sets(rows: pa.Table, words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The shingle set of each row's text, and whether it is the set of the row's class."""
    sizes, packed = rows["n_bytes"].to_numpy(), rows["packed"]
    one, two = rows["one"].to_numpy(), rows["two"].to_numpy()
    sets, fits = [], []
    # Runs of about SLICE_BYTES of text; a longer text is a run of its own.
    runs = np.cumsum(sizes) // SLICE_BYTES
    heads = np.flatnonzero(np.append(True, runs[1:] != runs[:-1]))
    for start, end in zip(heads, np.append(heads[1:], len(sizes))):
        part = range(start, end)
        texts = [pa.decompress(packed[k].as_buffer(), int(sizes[k]), "zstd", asbytes=True) for k in part]
        values, bounds = shingle_sets(pa.array(texts, pa.binary()).view(pa.string()), words)
        marks = set_marks(values, bounds)
        fits.append((marks[0] == one[start:end]) & (marks[1] == two[start:end]))
        sets += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return sets, np.concatenate(fits)


def linked(symbols: np.ndarray, sets: list[np.ndarray], own: np.ndarray, mixed_only: bool, percent: int, reach: int):
    """The smallest member that each member of a group is connected with.

    Only pairs within the signature distance are compared, on full sets; pairs already connected need no more.
    ``mixed_only`` leaves pairs of one block to another task.
    """
    sizes = np.array([len(x) for x in sets])
    codes = dense_ranks(np.concatenate(sets))[0]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    held = np.zeros(int(codes.max()) + 1, bool)
    label = np.arange(len(sets))
    for k in range(len(sets) - 1):
        maybe = (label[k + 1 :] != label[k]) & (distances(symbols[k + 1 :], symbols[k]) <= reach)
        if mixed_only:
            maybe &= own[k + 1 :] != own[k]
        others = np.flatnonzero(maybe) + k + 1
        if not len(others):
            continue
        mine = codes[starts[k] : starts[k] + sizes[k]]
        held[mine] = True
        if len(others) < 16:
            both = np.array([held[codes[starts[o] : starts[o] + sizes[o]]].sum() for o in others])
        else:
            both = np.add.reduceat(held[codes].astype(np.int64), starts)[others]
        held[mine] = False
        for o in others[100 * both >= percent * (sizes[others] + sizes[k] - both)]:
            low, high = sorted((label[k], label[o]))
            label[label == high] = low
    return label


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose shingle sets have ``100 * intersection >= percent * union``.

    Texts are lower-cased in A-Z; words are runs of anything but ASCII white space; a set holds the distinct runs of
    ``words`` words, or the whole sequence if there are fewer.  Needs ``doc_id`` (integer) and ``text``; other columns,
    whatever their names, are not read.  Returns one row per row: ``doc_id, n_shingles, component_id`` (the smallest
    id reachable by links, itself included) and ``kept`` (``doc_id = component_id``).  Null, empty and blank texts have
    an empty set and link with nothing.  A document with a null id links with nothing, has a null component and is
    kept.  Rows with equal ids are one document of several texts.  An empty table gives an empty result.
    """
    spark = documents.sparkSession
    small_batches(spark)
    chunks = chunk_count(percent / 100)
    reach = chunks * (ERRORS + 1) - 1
    signatures, signatures_path = stored(signed(documents, words), "signatures")
    usable = signatures.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("one", "two", "n_shingles")
    reps = classes.agg(F.min("doc_id").alias("rep"), F.min_by("symbols", "doc_id").alias("symbols"))
    reps, reps_path = stored(reps, "reps")
    keys = reps.select("rep", "symbols").mapInArrow(tidy(keyed(chunks)), "key long, rep long")
    # Keys are nearly all of what is shuffled, so they move once.
    same = Window.partitionBy("key")
    met = keys.withColumns({"pivot": F.min("rep").over(same), "last": F.max("rep").over(same)})
    groups = met.where("pivot < last").select("pivot", "rep").distinct()
    groups, groups_path = stored(groups, "groups")

    # Groups in blocks: every pair of blocks is one unit of work.
    dealt = class_texts(documents, reps, groups).selectExpr("* EXCEPT (places)", "inline(places)")
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    spot = ("pivot", "least(own, other) AS i", "greatest(own, other) AS j", "own")
    dealt = dealt.selectExpr(*spot, "rep", "one", "two", "symbols", "n_bytes", "packed")
    dealt = dealt.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["pivot", "i", "j"]):
            sets, fits = fitting_sets(table, words)
            table, sets = table.drop(["packed"]).filter(pa.array(fits)), [s for s, fit in zip(sets, fits) if fit]
            spot = np.stack([table[c].to_numpy() for c in ("pivot", "i", "j")], 1)
            heads = np.flatnonzero(np.append(True, (spot[1:] != spot[:-1]).any(axis=1)))
            ids, own, symbols = table["rep"].to_numpy(), table["own"].to_numpy(), symbol_matrix(table["symbols"])
            a, b = [], []
            for start, end in zip(heads, np.append(heads[1:], len(ids))):
                if end - start > 1:
                    part = slice(start, end)
                    label = linked(symbols[part], sets[part], own[part], spot[start, 1] != spot[start, 2], percent, reach)
                    joined = np.flatnonzero(label != np.arange(end - start))
                    a.append(ids[part][label[joined]])
                    b.append(ids[part][joined])
            if a:
                yield pa.record_batch({"a": np.concatenate(a), "b": np.concatenate(b)})

    found, _ = stored(connected(dealt.mapInArrow(tidy(compare), "a long, b long")), "components")
    removed(spark, groups_path)

    # Every document: its class, the component of the class.
    grouped = reps.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    grouped = grouped.select("one", "two", "n_shingles", F.coalesce("component", "rep").alias("component"))
    own = F.expr("IF(n_shingles > 0 AND doc_id IS NOT NULL, one, NULL)")
    result = signatures.withColumn("one", own).join(grouped, ["one", "two", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id").alias("component_id")
    return result.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
