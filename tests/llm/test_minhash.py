"""Near duplicates against all pairs by full sets, and the pigeonhole guarantee."""

import random

import numpy as np
import pytest
from brute import components, near_links

from layerwright.llm import minhash
from layerwright.llm.components import connected
from layerwright.llm.minhash import chunk_count, near_duplicates

SCHEMA = "doc_id long, text string, kept string, key int"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(400)]
    docs = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 12, 40, 160]))]
        for _ in range(rng.randrange(2, 14)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words))
    # A chain of small changes, and a group of copies.
    words = [rng.choice(vocabulary) for _ in range(120)]
    for k in range(15):
        words[7 * k] = f"new{k}"
        docs.append(" ".join(words).title())
    docs += ["same text of many copies here"] * 40 + ["One two", "one  TWO\n", "one", "", "  ", None]
    rng.shuffle(docs)
    return list(enumerate(docs)) + [(None, docs[0])]


def check(spark, docs, words, percent):
    rows = near_duplicates(frame(spark, docs), words, percent).collect()
    named = [(i, t) for i, t in docs if i is not None]
    sets, links = near_links(named, words, percent)
    want = components([i for i, _ in named], links)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i, _ in named}
    assert len(rows) == len(docs)
    return links


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, monkeypatch, words, percent):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    assert len(check(spark, corpus(), words, percent)) > 100


def test_full_marks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BITMAPS", 1)
    monkeypatch.setattr(minhash, "BITMAP_BITS", 4)
    assert len(check(spark, corpus(5), 3, 85)) > 100


def test_marks_keep_every_id_and_few_others(spark):
    rows = spark.sql("SELECT CAST(id - 10000 AS INT) AS doc_id, 'x' AS text FROM range(20000) UNION ALL SELECT NULL, 'y'")
    wanted = spark.sql("SELECT id - 10000 AS rep FROM range(0, 20000, 7)")
    kept = {r.doc_id for r in minhash.maybe_in(rows, "doc_id", wanted.unionAll(wanted)).collect()}
    asked = set(range(-10000, 10000, 7))
    assert asked <= kept and len(kept - asked) < 100 and None not in kept
    assert minhash.maybe_in(rows, "doc_id", wanted.where("false")).count() == 0


def test_keys_move_once_and_texts_of_no_group_stay(spark, monkeypatch):
    plans, store = {}, minhash.stored

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, label)

    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(minhash, "stored", seen)
    try:
        near_duplicates(frame(spark, corpus()), 3, 85)
        ids = spark.createDataFrame([(3, 5), (3, 3)], "pivot long, rep long")
        docs = spark.createDataFrame([(i, f"text {i}") for i in range(2000)], "doc_id long, text string")
        reps = spark.createDataFrame([(3, 1, 2, b"s")], "rep long, one long, two long, symbols binary")
        texts = minhash.class_texts(docs, reps, ids)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plans["groups"].count("hashpartitioning(key") == 1 and plans["groups"].count("MapInArrow") == 1
    # Texts of no group are left out before they are compressed.
    assert "BroadcastHashJoin" in texts[texts.index("MapInArrow") :]


def test_empty(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    row = near_duplicates(frame(spark, [(None, "a b")])).first()
    assert (row.component_id, row.kept) == (None, True)


def test_chunks_cover_the_limit():
    assert chunk_count(0.85) < chunk_count(0.8) <= 32
    # Any two signatures within reach share a key.
    chunks = 5
    reach = 2 * chunks - 1
    rng = np.random.default_rng(1)
    a = rng.integers(0, 9, (200, minhash.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(minhash.SYMBOLS, reach, replace=False)] += 100
    import pyarrow as pa

    make = minhash.keyed(chunks)
    for x, y in zip(a, b):
        batch = pa.record_batch({"rep": [1, 2], "symbols": [x.tobytes(), y.tobytes()]})
        out = next(make([batch])).to_pydict()
        mine = {k for k, r in zip(out["key"], out["rep"]) if r == 1}
        assert mine & {k for k, r in zip(out["key"], out["rep"]) if r == 2}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)] + [(None, 3), (4, None)]
    rows = connected(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = components({i for pair in real for i in pair}, real)
    assert dict((r.id, r.component) for r in rows) == want and len(rows) == len(want)
