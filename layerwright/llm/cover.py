"""Embedding near-dedup by dual traversal of cover trees.

Vectors are scaled to length one, where a cosine of at least ``similarity`` is a distance of at most ``limit``.  Vectors of
one label are dealt to shards by their nearest pivot, and each shard becomes a cover tree: nested levels of centres whose
radii halve, each node with the distance of its furthest descendant.  Pairs of shards, then pairs of nodes from the roots
down, are dropped when their centres are further apart than the limit and both covering radii allow, and taken as a whole
when even their furthest descendants are within the limit.  What remains is compared vector by vector, so the pairs are
exact.  Counts and a spanning forest leave a task, never the pairs, so a crowd of near copies stays small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .tables import stored

PIVOTS = 16
# Vectors the pivots are chosen from, and vectors per shard.  Both only shape the work.
PIVOT_SAMPLE = 1024
SHARD = 1024
# Rounding of a distance.
SLACK = 1e-7


def unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scale vectors to length one in double precision; null where a vector can't be compared."""
    for batch in batches:
        lists = batch["embedding"]
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        units: list[bytes | None] = [None] * batch.num_rows
        ends = np.cumsum(sizes)
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == size)
            vectors = flat[(ends[rows] - size)[:, None] + np.arange(size)]
            good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
            vectors, rows = vectors[good], rows[good]
            vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            for row, vector in zip(rows, vectors + 0.0):
                units[row] = vector.tobytes()
        yield pa.record_batch(
            {
                "vec_id": batch["vec_id"].cast(pa.int64()),
                "label": batch["label"],
                "size": pa.array(sizes, pa.int32()),
                "unit": pa.array(units, pa.binary()),
            }
        )


def matrix(column: pa.ChunkedArray | list, size: int) -> np.ndarray:
    values = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, size)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def far_pivots(vectors: np.ndarray, most: int) -> np.ndarray:
    """Each next pivot is the vector furthest from those before."""
    chosen = [0]
    gap = apart(vectors, vectors[:1])[:, 0]
    while len(chosen) < min(most, len(vectors)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, apart(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


class CoverTree:
    """Nodes in breadth-first order; the children of a node are ``first[n]`` to ``last[n]``."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        centre, radius, first, last, members = [0], [0.0], [0], [0], [np.arange(len(vectors))]
        scale = [2.0]
        node = 0
        while node < len(centre):
            own = members[node]
            gap = apart(vectors[own], vectors[centre[node] : centre[node] + 1])[:, 0]
            radius[node] = float(gap.max()) if len(own) > 1 else 0.0
            first[node] = last[node] = len(centre)
            if len(own) > 1:
                half = scale[node] / 2
                while half > radius[node] and half > SLACK:
                    half /= 2
                for c, part in self.net(own, centre[node], half):
                    centre.append(c)
                    members.append(part)
                    radius.append(0.0)
                    scale.append(half)
                    first.append(0)
                    last.append(0)
                last[node] = len(centre)
            node += 1
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.first, self.last, self.members = np.array(first), np.array(last), members
        self.leaf = self.first == self.last

    def net(self, own: np.ndarray, centre: int, half: float) -> Iterator[tuple[int, np.ndarray]]:
        """Centres further apart than ``half`` with the members nearest by; the node's centre comes first."""
        rest = np.concatenate(([centre], own[own != centre]))
        while len(rest):
            if half <= SLACK:  # as good as equal: every member for itself
                yield from ((int(c), rest[i : i + 1]) for i, c in enumerate(rest))
                return
            near = apart(self.vectors[rest], self.vectors[rest[:1]])[:, 0] <= half
            near[0] = True
            yield int(rest[0]), rest[near]
            rest = rest[~near]


def dual_links(
    a: CoverTree, b: CoverTree, weight_a: np.ndarray, weight_b: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Weighted numbers of links of each vector, and edges that connect what is linked.

    With one tree against itself, a vector is linked to itself too.
    """
    limit = float(np.sqrt(2 - 2 * similarity))
    count_a, count_b = np.zeros(len(weight_a), np.int64), np.zeros(len(weight_b), np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(0, 0)]
    while stack:
        m, n = stack.pop()
        ms = np.array([m]) if a.leaf[m] else np.arange(a.first[m], a.last[m])
        ns = np.array([n]) if b.leaf[n] else np.arange(b.first[n], b.last[n])
        dots = a.vectors[a.centre[ms]] @ b.vectors[b.centre[ns]].T
        reach = a.radius[ms][:, None] + b.radius[ns][None, :]
        gap = np.sqrt(np.maximum(2 - 2 * dots, 0))
        single = a.leaf[ms][:, None] & b.leaf[ns][None, :]
        x, y = np.nonzero(single & (dots >= similarity))
        x, y = a.centre[ms[x]], b.centre[ns[y]]
        np.add.at(count_a, x, weight_b[y])
        np.add.at(count_b, y, weight_a[x])
        edges.append((x, y))
        for i, j in zip(*np.nonzero(~single & (gap - reach <= limit + SLACK))):
            if gap[i, j] + reach[i, j] <= limit - SLACK:
                mine, yours = a.members[ms[i]], b.members[ns[j]]
                count_a[mine] += weight_b[yours].sum()
                count_b[yours] += weight_a[mine].sum()
                edges.append((mine, np.full(len(mine), yours[0])))
                edges.append((np.full(len(yours), mine[0]), yours))
            else:
                stack.append((int(ms[i]), int(ns[j])))
    return count_a, count_b, edges


def least_labels(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest node each of ``n`` nodes is connected with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            return label


def embedding_duplicates(
    embeddings: DataFrame, similarity: float = 0.93, pivots: int = PIVOTS, shard: int = SHARD
) -> DataFrame:
    """Links between vectors of equal label with a cosine of at least ``similarity``, and their components.

    Needs ``vec_id`` (integer), ``label`` and ``embedding`` (array of numbers); other columns, whatever their names, are
    not read.  Returns one row per row: ``vec_id, n_links`` (other vectors linked directly, copies included),
    ``component_id`` (smallest id reachable by links, itself included) and ``kept`` (``vec_id = component_id``).
    Vectors that are null, zero, or hold null or non-finite components, vectors without label or id, and vectors of
    different lengths link with nothing.  A row with a null id has a null component and is kept.  Rows with equal ids
    count as vectors of their own but share a component.  An empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    kind = embeddings.schema["label"].dataType.simpleString()
    units = embeddings.select("vec_id", "label", "embedding").mapInArrow(
        unit_rows, f"vec_id long, label {kind}, size int, unit binary"
    )
    units, _ = stored(units, "units")
    usable = units.where("unit IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    classes, _ = stored(
        usable.groupBy("label", "size", "unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "classes"
    )
    sample = classes.orderBy(F.xxhash64("id"), "id").select("size", "unit").limit(PIVOT_SAMPLE).collect()
    by_size: dict[int, np.ndarray] = {}
    for size in sorted({r.size for r in sample}):
        by_size[size] = far_pivots(matrix([r.unit for r in sample if r.size == size], size), pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest pivot; vectors of a length the sample has not met share a cell."""
        for batch in batches:
            sizes = batch["size"].to_numpy()
            cells = np.zeros(len(sizes), np.int32)
            for size in np.unique(sizes):
                if size in by_size:
                    rows = np.flatnonzero(sizes == size)
                    cells[rows] = apart(matrix(batch["unit"].take(pa.array(rows)).to_pylist(), size), by_size[size]).argmin(1)
            yield pa.record_batch([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    placed = classes.mapInArrow(place, f"label {kind}, size int, unit binary, id long, copies long, cell int")
    cells = placed.groupBy("label", "size", "cell").agg(F.expr(f"CAST(ceil(count(*) / {shard}) AS INT)").alias("parts"))
    dealt = placed.join(cells, ["label", "size", "cell"])
    dealt = dealt.withColumn("part", F.expr("CAST(pmod(xxhash64(id), parts) AS INT)"))

    def summarise(rows: pa.Table) -> pa.Table:
        """One row per shard: its vectors, and the range of their distances from every pivot."""
        size = rows["size"][0].as_py()
        vectors = matrix(rows["unit"], size)
        gaps = apart(vectors, by_size[size]) if size in by_size else np.zeros((len(vectors), 0))
        one = {c: rows[c].slice(0, 1) for c in ("label", "size", "cell", "part")}
        blobs = {
            "ids": rows["id"].to_numpy().tobytes(),
            "copies": rows["copies"].to_numpy().tobytes(),
            "vectors": vectors.tobytes(),
        }
        ranges = {"low": gaps.min(axis=0).tolist(), "high": gaps.max(axis=0).tolist()}
        return pa.table({**one, **{k: [v] for k, v in blobs.items()}, **{k: pa.array([v], pa.list_(pa.float64())) for k, v in ranges.items()}})

    shards = dealt.select("label", "size", "cell", "part", "unit", "id", "copies")
    shards = shards.groupBy("label", "size", "cell", "part").applyInArrow(
        summarise,
        f"label {kind}, size int, cell int, part int, ids binary, copies binary, vectors binary,"
        " low array<double>, high array<double>",
    )
    shards, _ = stored(shards.withColumn("shard", F.concat_ws("-", "label", "size", "cell", "part")), "shards")
    ranges = shards.select("label", "size", "shard", "low", "high")
    other = ranges.toDF("label", "size", "shard_b", "low_b", "high_b")
    limit = float(np.sqrt(2 - 2 * similarity)) + SLACK
    pairs = ranges.join(other, ["label", "size"]).where("shard <= shard_b")
    parted = f"exists(zip_with(low, high_b, (x, y) -> x - y > {limit}D), z -> z)"
    parted += f" OR exists(zip_with(low_b, high, (x, y) -> x - y > {limit}D), z -> z)"
    pairs = pairs.where(f"NOT ({parted})").select("size", "shard", "shard_b")
    blobs = shards.select("shard", "ids", "copies", "vectors")
    pairs = pairs.join(blobs, "shard").join(blobs.toDF("shard_b", "ids_b", "copies_b", "vectors_b"), "shard_b")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["shard"] == row["shard_b"]
                sides = []
                for end in ("", "_b")[: 1 if same else 2]:
                    ids, copies = (np.frombuffer(row[c + end], np.int64) for c in ("ids", "copies"))
                    sides.append((ids, copies, CoverTree(matrix([row["vectors" + end]], row["size"]))))
                (ids, copies, tree), (ids_b, copies_b, tree_b) = sides[0], sides[-1]
                n, n_b, edges = dual_links(tree, tree_b, copies, copies_b, similarity)
                x = np.concatenate([e[0] for e in edges])
                y = np.concatenate([e[1] for e in edges])
                if same:
                    found, counts = ids, n - copies
                else:
                    found, counts, y = np.concatenate((ids, ids_b)), np.concatenate((n, n_b)), y + len(ids)
                root = least_labels(len(found), x, y)
                linked = counts > 0
                yield pa.record_batch({"id": found[linked], "n": counts[linked], "root": found[root[linked]]})

    links, _ = stored(pairs.mapInArrow(link, "id long, n long, root long"), "links")
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    found, _ = stored(connected(links.select(F.col("id").alias("a"), F.col("root").alias("b"))), "components")
    known = classes.join(counts, "id", "left").join(found, "id", "left").select(
        "label",
        "size",
        "unit",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
    keyed = units.withColumn("unit", F.expr("IF(label IS NULL OR vec_id IS NULL, NULL, unit)"))
    result = keyed.join(known, ["label", "size", "unit"], "left")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
