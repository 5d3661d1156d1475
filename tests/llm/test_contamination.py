"""Decontamination against brute force."""

import random
import re

import pytest
from brute import lowered

from layerwright.llm import contamination
from layerwright.llm.contamination import decontaminated

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(lowered(text))


def brute(docs, items, window=13, percent=5):
    out = []
    for i, text in docs:
        seq = words(text)
        hit, found, longest = [False] * len(seq), set(), {}
        for item, test in items:
            test = words(test)
            w = min(window, len(test))
            for a in range(len(test) - w + 1 if w else 0):
                for b in range(len(seq) - w + 1):
                    if seq[b : b + w] == test[a : a + w]:
                        hit[b : b + w] = [True] * w
                        found.add(item)
                        n = w
                        while a + n < len(test) and b + n < len(seq) and seq[b + n] == test[a + n]:
                            n += 1
                        longest[item] = max(longest.get(item, (0, 0)), (n, -b))
        n_hit = sum(hit)
        bad = n_hit > 0 and 100 * n_hit >= percent * len(seq)
        out.append((i, len(seq), n_hit, tuple(sorted(found)), bad, tuple(sorted((k, -b, n) for k, (n, b) in longest.items()))))
    return out


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "An", "é", "x1", "Über", "a_b", "don't"] + [f"w{k}" for k in range(30)]
    sentence = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(k), sentence(rng.choice([1, 2, 5, 13, 14, 40]) + 30 * (k % 2))) for k in range(14)]
    items = [(k, t) for k, t in items if len(words(t)) > 1] + [("e", ""), ("n", None), ("p", "..."), ("3", items[1][1])]
    docs = []
    for i in range(40):
        parts = [sentence(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            test = (rng.choice(items)[1] or "").split(" ")
            a = rng.randrange(len(test))
            parts += [" ".join(test[a : a + rng.randrange(1, 60)]).upper(), sentence(rng.randrange(20))]
        docs.append((i, " ! ".join(parts)))
    docs += [(50, None), (51, ""), (52, "?"), (None, items[0][1]), (0, docs[0][1]), (53, sentence(3000) + " " + items[0][1])]
    return docs, items


@pytest.mark.parametrize("test_bytes", [16 << 20, 600])
def test_against_brute_force(spark, monkeypatch, test_bytes):
    monkeypatch.setattr(contamination, "TEST_BYTES", test_bytes)
    monkeypatch.setattr(contamination, "SHARD_BYTES", 2000)
    docs, items = corpus()
    table = spark.createDataFrame([(i, t, "x", i) for i, t in docs], "doc_id long, text string, hits string, n_words long")
    tests = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminated(table, tests, carry=("text",))
    rows = []
    for r in got.collect():
        found = tuple(sorted({m.item_id for m in r.matches}))
        best = {}
        for m in r.matches:
            best[m.item_id] = max(best.get(m.item_id, (0, 0)), (m.length, -m.start))
        rows.append((r.doc_id, r.n_words, r.n_hit, found, r.contaminated, tuple(sorted((k, -b, n) for k, (n, b) in best.items()))))
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(rows, key=order) == sorted(brute(docs, items), key=order)
    assert any(r[4] for r in rows) and not all(r[4] for r in rows if r[2])


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminated(docs, none).collect()] == [(1, 2, [], [], 0, False)]
    assert decontaminated(docs.limit(0), none).collect() == []
