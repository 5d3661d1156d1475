"""The source audit against plain Python, with digests wide and narrow."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from brute import lowered

from layerwright.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, digest string, term int, n int, value int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, ranks=200):
    docs = [(lang or "", source or "", TERM.findall(lowered(text))) for _, text, lang, source in rows]
    inside = defaultdict(Counter)
    for lang, _, terms in docs:
        inside[lang].update(set(terms))
    kept = {lang: {t for t, n in seen.items() if n >= least} for lang, seen in inside.items()}
    counts, langs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        terms = [t for t in terms if t in kept[lang]]
        counts[lang, source].update(terms)
        langs[lang].update(terms)

    def shares(count, lang):
        total = sum(count.values()) + len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept[lang]}

    p = {g: shares(c, g[0]) for g, c in counts.items()}
    q = {lang: shares(c, lang) for lang, c in langs.items()}
    gap = lambda a, b: (a - b) * (a - b) // b
    out = []
    for (lang, source), own in p.items():
        pairs = [(b, sum(gap(own[t], p[lang, b][t]) for t in own)) for a, b in p if a == lang and b != source]
        terms = [(t, gap(own[t], q[lang][t])) for t in own if counts[lang, source][t] and own[t] > q[lang][t]]
        for part, values, limit in (("pair", pairs, None), ("term", terms, ranks)):
            values.sort(key=lambda v: (-v[1], v[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(values[:limit])]
    return sorted(out)


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in source_divergence(frame, **settings).select("lang", "source", "part", "item", "value", "rank").collect())


def odd_rows():
    rng = random.Random(15)
    words = [f"{a}{b}" for a in ("k", "lé", "M", "日本", "x ") for b in "abcdefghijklmnop"]
    rows = []
    for i in range(250):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["web", "web", "web", "book", "É", "e", None])
        text = rng.choice([" ", "-", "3"]).join(rng.choices(words, k=int(rng.expovariate(0.05))))
        rows.append((i, text, lang, source))
    rows += [(500, None, "en", "web"), (501, "", "en", "void"), (502, "only here", "fr", "one"), (503, "123 ...", "pt", None)]
    rows += [(504, "same words twice twice", "it", "x")] * 3 + [(505, "Same", "it", "y"), (506, "ka " * 30_000, "en", "book")]
    return rows


@pytest.mark.parametrize("bits", [64, 5, 1])
def test_matches_plain_python(spark, bits):
    rows = odd_rows()
    assert run(spark, rows, bits=bits, ranks=7) == brute(rows, ranks=7)


def test_small_pieces(spark, monkeypatch):
    from layerwright.llm import divergence

    monkeypatch.setattr(divergence, "PIECE_BYTES", 50)
    rows = odd_rows()
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None, None)]) == []


def test_counts_move_once(spark, monkeypatch, capsys):
    from layerwright.llm import divergence

    rows, plans, keep = {}, {}, divergence.stored

    def stored(df, label):
        capsys.readouterr()
        df.explain()
        plans[label] = capsys.readouterr().out
        kept, path = keep(df, label)
        rows[label] = kept.count()
        return kept, path

    monkeypatch.setattr(divergence, "stored", stored)
    words = ["".join(w) for w in itertools.product("abcdefghij", repeat=3)]
    table = [(i, " ".join(words[i::50]) + " shared", "en", "web" if i % 2 else "book") for i in range(50)]
    assert run(spark, table) == brute(table)
    # One shuffle takes all counts, and no term that is not kept is written: one term, and a row for the groups.
    assert plans["audit-terms"].count("Exchange hashpartitioning") == 1
    assert rows["audit-terms"] == 2 and max(rows.values()) == 2
