"""Source mixing against plain Python."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

from brute import WORD

from layerwright.llm.mixing import PARTS, emitted, mixed

SCHEMA = "doc_id long, text string, source string, size string, target int, copies int, range int"


def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        left = total - 2 * sum(sizes[s] for s in capped)
        heft = sum(w for s, w in weight.items() if s not in capped)
        over = {s for s in sizes if s not in capped and left * weight[s] > 2 * sizes[s] * heft}
        if not over:
            return {s: Fraction(2 * sizes[s]) if s in capped else left * weight[s] / heft for s in sizes}
        capped |= over


def brute(rows):
    docs = [(i, len(WORD.findall(t or "")), s, t) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s, _ in docs:
        sizes[s] += n
    targets = brute_targets(sizes)
    out = []
    for s in sizes:
        per_copy = int(targets[s] * PARTS / sizes[s]) if sizes[s] else 0
        at = int(hashlib.md5(("0" if s is None else f"0:{s}").encode()).hexdigest()[:10], 16)
        for i, n, _, t in sorted((d for d in docs if d[2] == s), key=lambda d: (d[1], d[0] is not None, d[0] or 0)):
            copies = (at + per_copy) // PARTS - at // PARTS
            at += per_copy
            out.append((i, s, n, sizes[s], float(targets[s]), copies, copies * n))
    return out


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(parts)


def run(spark, rows, parts=4):
    mix = mixed(frame(spark, rows, parts)).drop("mark")
    return sorted(map(tuple, mix.collect()), key=str)


def odd_rows(rng):
    rows = []
    for i in range(600):
        source = rng.choice(["hot", "hot", "hot", "a", "b", "Z", "é", "", None, "tiny"]) if i else "tiny"
        rows.append((i, " ".join(["w x"] * int(rng.expovariate(0.02))) if i % 9 else rng.choice(["", None, "\t \v"]), source))
    rows += [(1000, "word " * 20_000, "hot"), (None, "no id", "a"), (2000, "alone", "one"), (2001, None, "nothing")]
    rows += [(3000, "the same row", "b")] * 300
    return rows


def test_matches_plain_python(spark):
    rows = odd_rows(random.Random(12))
    want = sorted(brute(rows), key=str)
    assert run(spark, rows) == want
    assert run(spark, rows[::-1], 1) == want
    taken, target, longest = defaultdict(int), {}, defaultdict(int)
    for _, s, n, _, t, copies, words in want:
        assert copies <= 2
        taken[s] += words
        target[s] = t
        longest[s] = max(longest[s], n)
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s]


def test_ranges_and_blocks_change_nothing(spark, monkeypatch):
    from layerwright.llm import mixing, ranking

    rows = odd_rows(random.Random(13))
    monkeypatch.setattr(ranking, "RANGE_ROWS", 17)
    monkeypatch.setattr(mixing, "BLOCK", 7)
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_emitted(spark):
    rows = odd_rows(random.Random(14))
    documents = frame(spark, rows)
    mix = mixed(documents)
    out = [(r.doc_id, r.text, r.source) for r in emitted(documents, mix).collect()]
    want = defaultdict(int)
    for i, s, n, _, _, copies, _ in brute(rows):
        want[i, s, n] += copies
    found = defaultdict(int)
    for i, t, s in out:
        found[i, s, len(WORD.findall(t or ""))] += 1
    assert found == {k: v for k, v in want.items() if v}
    assert {(i, t, s) for i, t, s in out} <= {(i, t, s) for i, t, s in rows}


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None), (2, "", "a")]) == sorted([(1, None, 0, 0, 0.0, 0, 0), (2, "a", 0, 0, 0.0, 0, 0)], key=str)
