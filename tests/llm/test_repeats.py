"""Substring and suffix dedup against brute force, and the suffix order against sorting."""

import random

import numpy as np
import pytest
from brute import WORD, repeats, sha
from pyspark.sql import functions as F

from layerwright.llm.blocks import substring_dedup
from layerwright.llm.prefix_free import corpus_order, suffix_dedup
from layerwright.llm.repeats import PART_BITS, laid_out

SCHEMA = "doc_id long, text string, chunk int, kept string"


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("the", "of", "an", "é", "ünd") for b in ("", "ion", "at", "re")]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [sentence(n) for n in (49, 50, 51, 120, 75)]
    docs = []
    for i in range(60):
        parts = [sentence(rng.randrange(1, 60))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), sentence(rng.randrange(0, 30))]
        docs.append((i * 7 % 61, rng.choice(["\n", " ", "\t  "]).join(parts)))
    docs += [(100, docs[3][1]), (101, "re " * 200), (102, "re " * 120), (103, None), (104, ""), (105, "  \n ")]
    docs += [(106, "one"), (107, sentence(20000)), (108, docs[7][1]), (108, docs[7][1]), (None, docs[5][1])]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 9, "x") for i, t in docs], SCHEMA)


def key(row):
    return tuple((x is not None, x) for x in row)


def run_words(spark, docs, chunk_bytes=1 << 20):
    rows = substring_dedup(frame(spark, docs), chunk_bytes=chunk_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, sha(r.kept)) for r in rows), key=key)
    want = []
    for i, words, gone in repeats(docs, lambda t: WORD.findall(t or ""), 50):
        want.append((i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    assert got == sorted(want, key=key)
    return rows


def run_bytes(spark, docs, chunk_bytes=1 << 20):
    rows = suffix_dedup(frame(spark, docs), chunk_bytes=chunk_bytes).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in rows), key=key)
    want = []
    for i, data, gone in repeats(docs, lambda t: (t or "").encode(), 50):
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        want.append((i, len(data), sum(gone), spans, sha(kept)))
    assert got == sorted(want, key=key)


@pytest.mark.parametrize("chunk_bytes", [8000, 1 << 20])
def test_against_brute_force(spark, chunk_bytes):
    rows = run_words(spark, corpus(), chunk_bytes)
    run_bytes(spark, corpus(), chunk_bytes)
    texts = {r.doc_id: r for r in rows}
    assert texts[106].text == "one" and texts[103].text is None and texts[105].text == "  \n "
    assert all(WORD.findall(r.text or "") == r.kept.split() for r in rows)
    assert any(0 < r.n_removed < r.n_words for r in rows)


def test_empty(spark):
    assert substring_dedup(frame(spark, [])).collect() == []
    assert suffix_dedup(frame(spark, [])).collect() == []
    run_words(spark, [(1, None)])
    run_bytes(spark, [(1, None), (2, "")])


@pytest.mark.parametrize("alphabet, n", [(b"ab", 300), (b"abcdefgh ", 4000), (b"a", 120)])
def test_order_is_lexicographic(alphabet, n):
    rng = random.Random(n)
    texts = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(n))) for _ in range(6)]
    texts += [texts[0], b"", texts[1][10:] + texts[2]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    ends = np.repeat(bounds[1:], np.diff(bounds))
    raw = data.tobytes()
    ordered = [raw[p : ends[p]] for p in corpus_order(data, bounds, len(data))]
    assert sorted(ordered) == ordered and len(ordered) == len(data)


def test_more_chunks_than_buckets(spark):
    """Spark's limit of buckets does not limit the chunks; rows without an id, here a third, lie in chunks of their own."""
    docs = corpus(6) + [(None, f"{k} {text}") for k, (_, text) in enumerate(corpus(7)[:35])]
    setting = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "10")
    try:
        size = sum(len((t or "").encode()) for _, t in docs)
        run_words(spark, docs, size // 60)
        run_bytes(spark, docs, size // 60)
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("chunk_bytes", [3000, 20000])
def test_a_third_under_one_id(spark, chunk_bytes):
    """Rows that share an id lie in several chunks; they do not cut each other, but ids before and after them do."""
    docs = corpus(8)
    for k, hot in enumerate((30, 103, -4)):
        docs += [(hot, f"{k} {n} {text}") for n, (_, text) in enumerate(docs[k * 9 : k * 9 + 30])]
    docs += [(None, f"{n} {text}") for n, (_, text) in enumerate(docs[:20])]
    run_words(spark, docs, chunk_bytes)
    run_bytes(spark, docs, chunk_bytes)


def test_chunks_follow_bytes(spark):
    """Long texts that lie side by side are cut apart; a chunk exceeds its size by one text at most."""
    docs = [(i, "x" * (9000 if 100 <= i < 140 else 10)) for i in range(1000)]
    docs += [(500, f"{k:09000d}") for k in range(60)] + [(None, f"{k:09000d}") for k in range(40)]
    table = frame(spark, docs)
    chunk, chunks = laid_out(table, 20000)
    rows = table.select("doc_id", F.octet_length("text").alias("size"), chunk.alias("chunk"))
    found = rows.groupBy((F.col("chunk") / (1 << PART_BITS)).cast("long").alias("part"), "chunk").agg(
        F.sum("size").alias("size"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    found = found.orderBy("chunk").collect()
    assert len(found) <= chunks and sum(r.size for r in found) == sum(len(t) for _, t in docs)
    named = [r for r in found if r.low is not None]
    assert max(r.size for r in named if not r.low == r.high == 500) < 20000 + 9000
    assert len([r for r in named if r.low == r.high == 500]) > 15 and len(found) - len(named) > 10
    assert all(a.high < b.low or a.part == b.part for a, b in zip(named, named[1:]))
