"""What two substring operators share: find windows that also occur in a document with a smaller id.

Documents are laid out by id into groups of about as many bytes, stored as a table bucketed by chunk; a bucket holds
several chunks where Spark's limit of buckets asks for it, and its task then takes them one after another.  A group is one
chunk, unless rows that share an id exceed it: these are a group of their own, dealt over several chunks by their text,
and so are rows without an id, which publish nothing.  A chunk of an earlier group then holds smaller ids only, so chunks
exchange plain sets of fingerprints, without ids or positions, and answers meet their chunk without moving its texts again:

1. every chunk publishes fingerprints of short anchors; each learns which of its own also occur in another chunk;
2. windows around those are published; each chunk learns which of them occur in a chunk of an earlier group;
3. every chunk adds what repeats within itself, and cuts.

Sets are sorted, cut by hash range and sent as differences, about three bytes a fingerprint.  A chunk sends a
fingerprint once however often it occurs in it, so a passage shared by a third of all documents is a single entry of
each chunk's set.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .ranking import ranged_sums
from .tables import released, removed, small_batches, stored
from .words import distinct, give_back, packed, slices, tidy, unpacked

CHUNK_BYTES = 8 << 20
# A chunk's number holds its group above these bits and its part of the group in them.
PART_BITS = 24
SETS = "slot int, chunk bigint, anchors binary, probes binary"
ANSWER = "chunk bigint, live binary, settled binary"
Pair = tuple[np.ndarray, np.ndarray]


def by_slot(chunk: int, anchors: np.ndarray, probes: np.ndarray, slots: int, bits: int) -> list[dict]:
    """Cut two sorted sets of values of so many bits by hash range.

    Anchors of 32 bits are no set of their own: they belong to the probes, one to each.
    """
    cuts = np.array([(i << bits) // slots for i in range(1, slots)], np.uint64)
    at = np.searchsorted(probes, cuts)
    beside = anchors.dtype == np.uint32
    pieces = zip(np.split(anchors, at if beside else np.searchsorted(anchors, cuts)), np.split(probes, at))
    rows = []
    for slot, (mine, asked) in enumerate(pieces):
        if len(mine) or len(asked):
            mine = mine.tobytes() if beside else packed(mine)
            rows.append({"slot": slot, "chunk": chunk, "anchors": mine, "probes": packed(asked)})
    return rows


def merged(blobs: pa.ChunkedArray, chunks: np.ndarray) -> Pair:
    """Values of all sets with the chunk each comes from, ordered by value, then chunk."""
    sets = [unpacked(b) for b in blobs.to_pylist()]
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(chunks, [len(s) for s in sets])
    order = np.lexsort((owner, values))
    return values[order], owner[order]


def ends_of_runs(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values with the smallest and the largest chunk of each; sorted as ``merged`` leaves them."""
    first = np.flatnonzero(np.concatenate((np.ones(min(len(values), 1), bool), values[1:] != values[:-1])))
    last = np.concatenate((first[1:], [len(values)])) - 1 if len(values) else first
    return values[first], owner[first], owner[last]


def before(low: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether chunk ``low`` belongs to an earlier group than chunk ``owner``."""
    return (low >> PART_BITS) < (owner >> PART_BITS)


def by_chunk(found: list[Pair]) -> dict[int, bytes]:
    """Each chunk's values as a sorted set."""
    values = np.concatenate([v for v, _ in found]) if found else np.zeros(0, np.uint64)
    owner = np.concatenate([o for _, o in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    values, owner = values[order], owner[order]
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    return {int(owner[a]): packed(distinct(values[a:b])) for a, b in zip(heads, np.append(heads[1:], len(owner)))}


def answers(live: list[Pair], settled: list[Pair]) -> pa.Table:
    """One row per chunk: values to look into, and values that need no more."""
    look, done = by_chunk(live), by_chunk(settled)
    rows = [{"chunk": c, "live": look.get(c), "settled": done.get(c)} for c in sorted(look.keys() | done.keys())]
    return pa.Table.from_pylist(
        rows, schema=pa.schema([("chunk", pa.int64()), ("live", pa.binary()), ("settled", pa.binary())])
    )


def match_anchors(sets: pa.Table) -> pa.Table:
    """Probes that are an anchor of an earlier chunk, and anchors that are a probe of a later one."""
    chunks = sets["chunk"].to_numpy()
    anchors, probes = merged(sets["anchors"], chunks), merged(sets["probes"], chunks)
    found = []
    for (values, owner), (others, low, high), later in (
        (probes, ends_of_runs(*anchors), True),
        (anchors, ends_of_runs(*probes), False),
    ):
        if len(others) and len(values):
            at = np.minimum(np.searchsorted(others, values), len(others) - 1)
            hit = (others[at] == values) & ((low[at] < owner) if later else (high[at] > owner))
            found.append((values[hit], owner[hit]))
    return answers(found, [])


def match_shared(sets: pa.Table) -> pa.Table:
    """Probes that occur in several chunks; settled in later groups if the value beside them is always the same."""
    blobs, chunks = sets["probes"].to_pylist(), sets["chunk"].to_numpy()
    parts = [unpacked(b) for b in blobs]
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    beside = np.frombuffer(b"".join(sets["anchors"].to_pylist()), np.uint32)
    owner = np.repeat(chunks, [len(p) for p in parts])
    order = np.lexsort((owner, values))
    values, owner, beside = values[order], owner[order], beside[order]
    known, low, high = ends_of_runs(values, owner)
    if not len(known):
        return answers([], [])
    heads = np.searchsorted(values, known)
    alike = np.minimum.reduceat(beside, heads) == np.maximum.reduceat(beside, heads)
    at = np.repeat(np.arange(len(known)), np.diff(heads, append=len(values)))
    shared = low[at] < high[at]
    look, done = shared & ~alike[at], shared & alike[at] & before(low[at], owner)
    return answers([(values[look], owner[look])], [(values[done], owner[done])])


def match_earlier(sets: pa.Table) -> pa.Table:
    """Values that occur in a chunk of an earlier group."""
    values, owner = merged(sets["probes"], sets["chunk"].to_numpy())
    known, low, _ = ends_of_runs(values, owner)
    hit = before(low[np.searchsorted(known, values)], owner) if len(values) else np.zeros(0, bool)
    return answers([(values[hit], owner[hit])], [])


def joined_sets(table: pa.Table, column: str) -> np.ndarray:
    parts = [unpacked(b) for b in table[column].to_pylist()]
    return distinct(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def laid_out(documents: DataFrame, chunk_bytes: int) -> tuple[Column, int]:
    """Each row's chunk, and the number of chunks.

    Bytes are added up per id, then over the ids in order; a group begins where the sum passes a multiple of
    ``chunk_bytes``.  Ids with several rows and more bytes than that are groups of their own.  Only the first id of each
    group and its number of chunks come to the driver: about as many as Spark's own range partitioning collects.
    """
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count("*")
    sizes = documents.groupBy("doc_id").agg(F.count("*").alias("n"), size.alias("size"))
    sizes, path = stored(sizes, "sizes")
    parts = F.ceil(F.col("size") / chunk_bytes)
    nameless = sizes.where("doc_id IS NULL").select(parts).first()
    placed = ranged_sums(sizes.where("doc_id IS NOT NULL"), [], [F.col("doc_id")], "size", "places")
    split = (F.col("n") > 1) & (F.col("size") > chunk_bytes)
    groups = placed.groupBy(F.expr(f"before DIV {chunk_bytes}"), split.alias("split")).agg(
        F.min("doc_id").alias("first"), F.max(F.when(split, parts).otherwise(1)).alias("parts")
    )
    found = groups.select("first", "parts").orderBy("first").collect()
    removed(documents.sparkSession, path)
    firsts = np.array([r["first"] for r in found], np.int64)
    counts = np.array([nameless[0] if nameless else 1] + [r["parts"] for r in found], np.int64)

    @F.arrow_udf("bigint")
    def chunk(ids: pa.Array, marks: pa.Array) -> pa.Array:
        group = np.searchsorted(firsts, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), side="right")
        group[ids.is_null().to_numpy(zero_copy_only=False)] = 0
        return pa.array((group << PART_BITS) | marks.to_numpy(zero_copy_only=False) % counts[group])

    return chunk(F.col("doc_id"), F.xxhash64("text")), int(counts[1:].sum() + (counts[0] if nameless else 0))


def resolve_repeats(
    documents: DataFrame,
    fingerprints: Callable[[pa.Table], Pair],
    windows: Callable[[pa.Table, np.ndarray], np.ndarray],
    resolve: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table],
    schema: str,
    match: Callable[[pa.Table], pa.Table] = match_anchors,
    bits: int = 40,
    chunk_bytes: int = CHUNK_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Run the first two steps; the third runs as the result is read.

    ``fingerprints(rows)`` gives a chunk's sorted anchors and probes of ``bits`` bits; a chance hit among them costs
    time only, as windows carry full hashes.  ``match`` compares them between chunks.  ``windows(rows, live)`` gives
    the sorted window hashes around the live ones, ``resolve(rows, earlier, settled)`` the result rows, given the
    windows that occur earlier and the probes that ``match`` has settled.  ``documents`` has ``doc_id, text``; rows with a
    null id must not publish anything.  Rows that repeat both id and text lie in one chunk.
    Columns in ``carry`` reach ``resolve`` as ``carried_0`` and so on.  The laid-out texts and the answers stay in the shared folder, as the result reads them.
    """
    spark = documents.sparkSession
    small_batches(spark)
    chunk, chunks = laid_out(documents, chunk_bytes)
    slots = chunks = max(chunks, 1)
    name, path = f"chunks_{uuid.uuid4().hex}", scratch_path(spark, "chunks")
    carried = (F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry))
    buckets = min(chunks, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    rows = documents.select("doc_id", "text", *carried, chunk.alias("chunk")).repartition(buckets, "chunk")
    writer = rows.write.bucketBy(buckets, "chunk").option("path", path).option("compression", "zstd")
    writer.saveAsTable(name)
    del rows, writer
    released(spark)
    table = spark.table(name)

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for chunk in rows["chunk"].unique().to_pylist():
                own = rows.filter(pc.equal(rows["chunk"], chunk))
                for part in slices(own, "text", chunk_bytes):
                    anchors, probes = fingerprints(part)
                    out = by_slot(chunk, anchors, probes, slots, bits)
                    yield from pa.Table.from_pylist(out, schema=SETS_ARROW).to_batches()

    def publish_windows(rows: pa.Table, live: pa.Table) -> pa.Table:
        found = joined_sets(live, "live")
        if not rows.num_rows or not len(found):
            return pa.Table.from_pylist([], schema=SETS_ARROW)
        hashes = windows(rows, found)
        give_back()
        out = by_slot(rows["chunk"][0].as_py(), hashes[:0], hashes, slots, 64)
        return pa.Table.from_pylist(out, schema=SETS_ARROW)

    def finish(rows: pa.Table, earlier: pa.Table) -> pa.Table:
        result = resolve(rows, joined_sets(earlier, "live"), joined_sets(earlier, "settled"))
        give_back()
        return result

    texts = table.select("doc_id", "text", "chunk")
    sets = texts.mapInArrow(tidy(publish), SETS)
    live = sets.repartition(slots, "slot").groupBy("slot").applyInArrow(match, ANSWER)
    live, _ = stored(live, "live")
    released(spark)
    sets = texts.groupBy("chunk").cogroup(live.groupBy("chunk")).applyInArrow(publish_windows, SETS)
    earlier = sets.repartition(slots, "slot").groupBy("slot").applyInArrow(match_earlier, ANSWER)
    earlier, _ = stored(earlier, "earlier")
    released(spark)
    none = F.lit(None).cast("binary")
    earlier = earlier.select("chunk", "live", none.alias("settled")).unionAll(
        live.select("chunk", none.alias("live"), "settled").where("settled IS NOT NULL")
    )
    return table.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(finish, schema)


SETS_ARROW = pa.schema(
    [("slot", pa.int32()), ("chunk", pa.int64()), ("anchors", pa.binary()), ("probes", pa.binary())]
)
