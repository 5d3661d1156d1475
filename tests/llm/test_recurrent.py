"""Language-model scores: counts exactly, probabilities that add up, gradients, and gain on held-out text."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from brute import WORD, lowered

from layerwright.llm import recurrent as R
from layerwright.llm.queries import op10_lm_scoring
from layerwright.llm.recurrent import Network, Vocabulary, language_scores, scored


def base(rows, held):
    train = Counter()
    ends = 0
    for (_, t), h in zip(rows, held):
        if not h:
            train.update(WORD.findall(lowered(t)))
            ends += 1
    n, v = sum(train.values()) + ends, len(train) + (ends > 0)
    out = []
    for (i, t), h in zip(rows, held):
        words = WORD.findall(lowered(t))
        counts = [train[w] for w in words] + [ends]
        out.append((i, h, len(counts), sum(c > 0 for c in counts), n, sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in counts)))
    return out


def check(rows, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


@pytest.mark.parametrize("head", [1 << 18, 40])
def test_base_scores(spark, monkeypatch, head):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:60]
    rows = list(enumerate(texts + [None, "", " \n", "New WORD new", "x" * 100000])) + [(None, "null id"), (3, texts[3])]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, h string, row int")
    result = language_scores(table, "doc_id % 5 = 1", head).collect()
    check(result, base(rows, [i is not None and i % 5 == 1 for i, _ in rows]))
    assert all(math.isfinite(r.score) and r.score < 0 for r in result)


def test_no_training(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = language_scores(table, "true").collect()
    check(rows, base([(1, "a b"), (2, None)], [True, True]))
    assert language_scores(table.where("false"), "true").collect() == []


def test_query_gains_on_held_out_text(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op10_lm_scoring(spark, sf_dir).collect()
    check(rows, base(texts, [crc32(str(i).encode()) % 5 == 1 for i, _ in texts]))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def toy(seed=1):
    rng = np.random.default_rng(seed)
    known = Vocabulary(
        np.arange(10, dtype=np.uint64), np.arange(10, 0, -1), np.arange(10), 4, 59, 11, np.full(R.TAIL, 3), np.full(R.TAIL, 2)
    )
    net = Network.start(known)
    net = Network(net.flat + rng.normal(scale=0.3, size=Network.size()))
    return net, rng


def test_probabilities_add_up():
    net, rng = toy()
    state = rng.normal(size=(1, R.STATE)).astype(np.float32)
    targets = np.arange(R.WORDS + R.TAIL)
    total = np.exp(net.log_probability(np.repeat(state, len(targets), 0), targets).astype(np.float64)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_score_does_not_depend_on_windows_or_neighbours(monkeypatch):
    net, rng = toy()
    texts = [rng.integers(0, R.WORDS + R.TAIL, n) for n in (5, 70, 1, 33, 64, 200)]
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    together = scored(net, np.concatenate(texts), edges)
    for k, text in enumerate(texts):
        state, total = np.zeros((1, R.STATE), np.float32), 0.0
        for token in text:
            total += float(net.log_probability(state, np.array([token]))[0])
            state, _ = net.step(state, np.array([token]))
        assert together[k] == pytest.approx(total, rel=1e-4)


def test_gradient():
    net, rng = toy()
    tokens = rng.integers(0, R.WORDS + R.TAIL, (6, 3))
    first = rng.random((6, 3)) < 0.2
    real = np.ones((6, 3), np.float32)
    real[5, 2] = 0
    state = rng.normal(size=(3, R.STATE)).astype(np.float32)
    grad, _, _ = net.gradient(state, tokens, first, real)

    def loss(flat):
        other = Network(flat)
        return -other.gradient(state, tokens, first, real)[1] / real.sum()

    checked = np.argsort(-np.abs(grad))[:40:4]
    for k in checked:
        moved = [net.flat.astype(np.float64).copy() for _ in range(2)]
        moved[0][k] += 1e-2
        moved[1][k] -= 1e-2
        slope = (loss(moved[0]) - loss(moved[1])) / 2e-2
        assert slope == pytest.approx(float(grad[k]), rel=0.05, abs=2e-4)


def test_every_training_document_reaches_the_network(spark):
    texts = [f"w{k} v{k} u{k}" for k in range(8)]

    def fitted(texts):
        table = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
        known = R.vocabulary(R.counted_words(table), len(texts), R.HEAD)
        return R.fit_network(R.prepared(table, known).select("mark", "tokens"), known).flat

    whole = fitted(texts)
    # The same words in another order leave all counts as they are.
    for k in range(len(texts)):
        assert (fitted(texts[:k] + [f"u{k} v{k} w{k}"] + texts[k + 1 :]) != whole).any()


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_TOKENS", 3000)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:80]
    table = spark.createDataFrame([*enumerate(texts), *[(900, "the same row again")] * 40], "doc_id long, text string")

    def scores(parts):
        rows = language_scores(table.repartition(parts), "doc_id % 5 = 1").collect()
        return sorted((r.doc_id, r.base_score, r.score) for r in rows)

    for a, b in zip(scores(2), scores(6), strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], rel=1e-4)


def test_copies_are_spread_and_counted(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_TOKENS", 100)
    rows = [(7, b"\0" * 20, k) for k in range(95)] + [(8, b"\0" * 2000, 0), (9, b"\1\0", 0), (9, b"\2\0", 0)]
    dealt = R.dealt(spark.createDataFrame(rows, "mark long, tokens binary, k int"), 5, 2).collect()
    times = Counter()
    for r in dealt:
        times[r.mark, bytes(r.tokens)] += r.times
        assert r.times * len(r.tokens) <= 200 or r.times == 1
    assert times == Counter((m, t) for m, t, _ in rows)
    assert len({(r.round, r.shard) for r in dealt if r.mark == 7}) > 3
