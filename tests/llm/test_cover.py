"""Embedding links against all pairs, and the cover tree's own promises."""

import numpy as np
import pytest
from brute import components

from layerwright.llm.cover import CoverTree, dual_links, embedding_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, unit int, id string"


def crowd(seed=1, dim=6):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        for _ in range(8):
            base = rng.normal(size=dim)
            for _ in range(rng.integers(1, 25)):
                rows.append((base + rng.normal(size=dim) * rng.choice([0.02, 0.2, 0.4]), label))
    rows += [(rows[0][0], 0)] * 30 + [(rows[0][0] * 2, 0)] * 5 + [(rows[3][0], None)] * 2
    rows = [(k, [float(np.float32(x)) for x in v], label) for k, (v, label) in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * dim, 1), (n + 2, [float("nan")] + [1.0] * (dim - 1), 1), (n + 3, [], 1)]
    rows += [(n + 4, [float("inf")] + [1.0] * (dim - 1), 1), (n + 5, [None] + [1.0] * (dim - 1), 1), (n + 6, [1.0] * 3, 1)]
    rows += [(n + 7, [2.0] * 3, 1), (None, rows[0][1], 0), (n + 8, [1e30] * dim, 2), (n + 9, [1e-30] * dim, 2)]
    return rows


def usable(row):
    _, v, label = row
    return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and row[0] is not None


@pytest.mark.parametrize("shard", [8, 1024])
def test_against_all_pairs(spark, shard):
    rows = crowd()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = embedding_duplicates(table, pivots=4, shard=shard).collect()
    links, number = [], {r[0]: 0 for r in rows}
    good = [r for r in rows if usable(r)]
    for k, (i, v, label) in enumerate(good):
        for j, w, other in good[k + 1 :]:
            if label == other and len(v) == len(w):
                x, y = np.array(v) / np.abs(v).max(), np.array(w) / np.abs(w).max()
                if x @ y >= 0.93 * np.linalg.norm(x) * np.linalg.norm(y):
                    links.append((i, j))
                    number[i] += 1
                    number[j] += 1
    want = components([r[0] for r in rows if r[0] is not None], links)
    assert len(got) == len(rows) and len(links) > 1000
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (number[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)


def test_empty(spark):
    assert embedding_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("spread", [0.01, 0.3, 5])
def test_tree_covers_and_nests(spread):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(150, 5)) * spread + [1, 0, 0, 0, 0]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.concatenate((vectors, vectors[:3]))
    tree = CoverTree(vectors)
    for node, own in enumerate(tree.members):
        gap = np.linalg.norm(vectors[own] - vectors[tree.centre[node]], axis=1)
        assert gap.max() <= tree.radius[node] + 1e-7
        children = range(tree.first[node], tree.last[node])
        if len(own) > 1:
            assert sorted(np.concatenate([tree.members[c] for c in children])) == sorted(own)
            assert tree.centre[node] in tree.centre[list(children)]
    ones = np.ones(len(vectors), np.int64)
    count, _, _ = dual_links(tree, tree, ones, ones, 0.93)
    assert (count == (vectors @ vectors.T >= 0.93).sum(axis=1)).all()
