"""The pipeline's stages on a small table with planted cases, and their effect on the next stage."""

import random

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = {"en": ["the", "of", "and", "think", "that", "with", "house"], "de": ["der", "und", "das", "für", "nicht", "haus", "schön"]}
    words = {k: v + [v[i % 7] + v[j % 7] for i in range(7) for j in range(7)] for k, v in vocabulary.items()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    docs = [(k, text("en" if k % 2 else "de", rng.randrange(80, 300)), "en" if k % 2 else "de") for k in range(60)]
    near = docs[4][1].split(" ")
    near[10] = "house"
    passage = text("en", 70)
    item = text("en", 40)
    docs += [(100, docs[3][1], "en"), (101, " ".join(near), "de"), (102, None, "en"), (103, "123 456 !!", None)]
    docs += [(104, text("en", 60) + " " + passage + " " + text("en", 60), "en"), (105, text("en", 80) + "\n" + passage, "en")]
    docs += [(106, text("en", 100) + " " + item + " " + text("en", 30), "en"), (107, "", "de"), (None, text("de", 90), "de")]
    rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t, lang in docs]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return {r[0]: r for r in rows}, passage


def test_stages(spark, tmp_path):
    rows, passage = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    gone = [{102, 103, 107}, {100, 101}, set(), {106}]
    left = set(rows)
    for (name, stage), dropped in zip(STAGES[:-1], gone, strict=True):
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == COLUMNS
        left -= dropped
        assert {r.doc_id for r in docs.collect()} == left, name
        for r in docs.collect():
            if r.doc_id != 105 or name in ("language_id", "minhash_near_dedup"):
                assert tuple(r) == rows[r.doc_id]
            else:
                want = rows[105][1].split("\n")[0]
                assert (r.text, r.n_chars, r.lang) == (want, len(want), "en")
    pieces = STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == left
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Where a document is cut depends on its neighbours in the task; its tokens do not.
    assert rejoined(whole) == rejoined(pieces)
    assert None in rejoined(whole)


def rejoined(pieces):
    """The token ids of each document, from gapless pieces."""
    tokens = {}
    for p in sorted(pieces, key=lambda p: p.start):
        done = tokens.setdefault(p.doc_id, b"")
        assert len(done) == 4 * p.start and len(p.ids) == 4 * p.length
        tokens[p.doc_id] = done + bytes(p.ids)
    assert all(len(tokens[p.doc_id]) == 4 * p.doc_tokens for p in pieces)
    return tokens


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
