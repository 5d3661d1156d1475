"""Language identification by held-out accuracy, and its defined results on odd input."""

import numpy as np
import pyarrow as pa

from layerwright.llm.language import FEATURES, clustered, fit_languages, gram_counts, identified, smallest_marks
from layerwright.llm.queries import op6_language_id


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_language_id(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.5
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= len(rows) // 100


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string, place int"
    train = [(k, "the cat and the dog sat on the mat " * (k % 3 + 1), "en") for k in range(30)]
    train += [(k + 50, "der hund und die katze saßen auf der matte", "de") for k in range(30)]
    train += [(99, None, "fr"), (100, "le chat", None), (None, "the end of the thing", "en")]
    table = spark.createDataFrame([(*r, "x", 1) for r in train], schema)
    model = fit_languages(table)
    odd = [(1, None), (2, ""), (3, "12 34 !?"), (4, "The Dog"), (5, "日本語のテキスト"), (None, "die Katze und der Hund"), (4, "The Dog")]
    odd += [(6, "the dog " * 50000), (7, "é")]
    got = identified(spark.createDataFrame([(i, t, "zz", "x", 1) for i, t in odd], schema), model, carry=("score",)).collect()
    by = [(r.doc_id, r.lang_pred) for r in got]
    assert by[:4] == [(1, "und"), (2, "und"), (3, "und"), (4, "en")] and by[5] == (None, "de") and by[6] == (4, "en")
    assert [r.rejected for r in got][:4] == [True, True, True, False] and got[4].rejected and by[7] == (6, "en")
    assert got[4].lang_pred in ("en", "de")
    nothing = fit_languages(table.where("false"))
    assert identified(table, nothing).select("lang_pred").distinct().first().lang_pred == "und"
    assert identified(table.where("false"), model).collect() == []


def test_counts_stay_in_their_text():
    together = gram_counts(pa.array(["abc", None, "", "Abc"]))
    alone = gram_counts(pa.array(["abc"]))
    assert (together[0] == alone[0]).all() and (together[3] == alone[0]).all() and together.shape == (4, FEATURES)
    assert together[1:3].sum() == 0 and alone.sum() == 4 + 3


def test_clusters_are_unit_length():
    rng = np.random.default_rng(1)
    vectors = np.abs(rng.normal(size=(40, 8))).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    made = clustered(vectors, 4)
    assert made.shape == (4, 8) and np.allclose(np.linalg.norm(made, axis=1), 1, atol=1e-5)
    assert len(clustered(vectors[:2], 4)) == 2


def test_few_marks_are_ranked(spark):
    rng = np.random.default_rng(2)
    rows = [(lang, int(m)) for lang, n in (("en", 30000), ("de", 3000), ("fr", 5)) for m in rng.integers(-(1 << 63), 1 << 63, n)]
    rows += [("en", 42)] * 500 + [("en", min(m for k, m in rows if k == "en"))] * 20
    marks = spark.createDataFrame(rows, "lang string, mark long")
    cuts = smallest_marks(marks, 1500)
    want = {k: sorted(m for lang, m in rows if lang == k)[:1500][-1] for k in ("en", "de", "fr")}
    assert {r.lang: r.cut for r in cuts.collect()} == want
    assert {r.lang: r.cut for r in smallest_marks(marks.where("mark = 42"), 1500).collect()} == {"en": 42}
    # No window sees the rows themselves, only counts of them.
    plan = cuts._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    assert len(windows) == 2 and all("Aggregate" in plan[i + 1] for i in windows)


def test_labelled_junk_does_not_admit_other_languages(spark):
    words = "the cat and dog sat on mat with some people who were going to their house".split()
    rng = np.random.default_rng(4)
    clean = [" ".join(rng.choice(words, 12)) for _ in range(1490)]
    russian, short = "Это простой русский текст о погоде", "the dog"
    # Texts without letters, and more kinds of junk than there are centroids.
    for junk in (["12 34", "!?"], [f"{c * 5} " * 4 for c in "zxjqv"]):
        table = spark.createDataFrame([(k, t, "en") for k, t in enumerate(clean + junk)], "doc_id long, text string, lang string")
        _, _, rejected = fit_languages(table).predict(pa.array([russian, short]))
        assert rejected.tolist() == [True, False]
