"""URL rules against plain Python, and mined rules against counting."""

import math
import re
import time
from itertools import combinations

import pytest

from layerwright.llm.queries import URL_RULES, op5_url_filter
from layerwright.llm.url_rules import judge_urls

SCHEMA = "page_id long, url string, host string, verdict int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", after[len(host) :])[0]


def fixed(host, path, rules):
    best = None
    for kind, at, begin in rules:
        if (host == at or host.endswith("." + at)) and path.startswith(begin):
            if best is None or len(at + begin) > len(best[1]):
                best = (kind, at + begin)
    return best


def test_parts_and_fixed_rules(spark):
    urls = [None, "", "no scheme", "://", "HTTP://WWW.Example.COM/en/É?x#y", "a://b://c", "x://example.com?en/", "x://h#/a?b"]
    urls += ["http://example.net/es/1", "http://notexample.com/en/1", "http://net/fr/", "http://www.example.com/en/a\nb"]
    urls += ["http://example.com/en/x", "http://m.example.com/en/x", "http://ÀB.com/", "http://a.www.example.com/en/", "u://" + "a/" * 5000]
    rows = [(k, u, "x", 1) for k, u in enumerate(urls)] + [(None, urls[4], "x", 1), (4, urls[5], "x", 1)]
    pages = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([], "page_id long, blocked boolean")
    got = judge_urls(pages, labels, URL_RULES).collect()
    assert len(got) == len(rows)
    want = sorted((k is not None, k or 0, *parts(u)) for k, u, *_ in rows)
    assert sorted((r.page_id is not None, r.page_id or 0, r.host, r.path) for r in got) == want
    for r in got:
        best = fixed(r.host, r.path, URL_RULES)
        assert (r.rule, r.verdict) == ((best[1], best[0]) if best else (None, "allow"))
    assert judge_urls(spark.createDataFrame([], SCHEMA), labels, URL_RULES).collect() == []


def test_mined_rules(spark):
    """Spam is what has both a casino folder and a tracking parameter, or one host."""
    rows, marks = [], []
    for k in range(1200):
        folder, query = ("casino" if k % 3 == 0 else "news"), ("?ref=1" if k % 2 == 0 else "")
        host = "spam.test" if k % 40 == 7 else f"h{k % 5}.test"
        rows.append((k, f"https://{host}/{folder}/{k}{query}", "x", 1))
        bad = host == "spam.test" or (folder == "casino" and query)
        if k % 4 != 1:
            marks.append((k, bool(bad)))
    labels = spark.createDataFrame(marks + marks[:50] + [(None, True)], "page_id long, blocked boolean")
    got = judge_urls(spark.createDataFrame(rows, SCHEMA), labels, [], 0.005, 0.9).collect()
    for r, (k, url, *_) in zip(sorted(got), sorted(rows)):
        bad = "spam.test" in url or ("casino" in url and "?" in url)
        assert (r.page_id, r.verdict) == (k, "block" if bad else "allow")


def tokens_of(url):
    """A plain restatement of the tokens."""
    host, path = parts(url)
    if not host:
        return frozenset()
    labels, folders = host.split("."), path.split("/")[:-1]
    ending = re.search(r"\.([A-Za-z0-9]+)\Z", path)
    query = re.match(r"[^?#]*\?([^#]*)", url)
    found = {"host=" + ".".join(labels[k:]) for k in range(len(labels))} | {"dir=" + f for f in folders}
    found |= {"query=" + q.split("=")[0] for q in (query[1] if query else "").split("&")}
    found |= {"ending=" + (ending[1] if ending else "")}
    scheme = re.sub("[A-Z]", lambda m: m[0].lower(), url.split("://")[0])
    return frozenset(t for t in found if not t.endswith("=")) | {"scheme=" + scheme}


def plain_rules(baskets, support, confidence, rows):
    """Every combination of items by counting: closed, not implied by part of its items, no part as sure."""
    least = max(math.ceil(support * len(baskets)), rows)
    held = {}
    for n, (tokens, _) in enumerate(baskets):
        for t in tokens:
            held.setdefault(t, set()).add(n)
    items = {}
    for t, where in held.items():
        if len(where) >= least:
            items.setdefault(frozenset(where), set()).add(t)
    blocked = {n for n, (_, b) in enumerate(baskets) if b}
    level = {frozenset([k]): where for k, where in enumerate(items)}
    members, kept = list(items.values()), {}
    while level:
        kept |= level
        wider = {}
        for (a, x), (b, y) in combinations(level.items(), 2):
            both, where = a | b, x & y
            if len(both) == len(a) + 1 and len(where) >= least:
                if all(both - {i} in level and len(level[both - {i}]) > len(where) for i in both):
                    wider[both] = where
        level = wider
    sure = {c: len(w & blocked) / len(w) for c, w in kept.items() if len(w & blocked) >= least}
    sure = {c: s for c, s in sure.items() if s >= confidence}
    best = {c: s for c, s in sure.items() if not any(o < c and sure[o] >= s for o in sure)}
    return {frozenset().union(*(members[i] for i in c)): s for c, s in best.items()}


@pytest.mark.parametrize("sf, support, confidence", [("sf0.1", 0.002, 0.3), ("sf0.1", 0.01, 0.27), ("sf0.01", 0.002, 0.8)])
def test_verdicts(spark, sf, support, confidence):
    """All verdicts of the test table, fixed and mined, against plain Python; low confidences, as its labels are noise."""
    tables = {name: spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet") for name in ("pages", "labels")}
    pages = {r.page_id: r.url for r in tables["pages"].collect()}
    bad = {}
    for r in tables["labels"].collect():
        bad[r.doc_id] = bad.get(r.doc_id, False) or r.quality == 0 or r.toxic == 1
    baskets = [(tokens_of(u), bad[k]) for k, u in pages.items() if k in bad and parts(u)[0]]
    rules = plain_rules(baskets, support, confidence, 5)
    assert bool(rules) == (confidence < 0.8)
    if confidence == 0.8:
        rows = op5_url_filter(spark, f"/root/testdata/{sf}").collect()
    else:
        labels = spark.createDataFrame(list(bad.items()), "page_id long, blocked boolean")
        rows = judge_urls(tables["pages"], labels, URL_RULES, support, confidence).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.host, r.path) == parts(pages[r.page_id])
        best = fixed(r.host, r.path, URL_RULES)
        mined = "block" if any(rule <= tokens_of(pages[r.page_id]) for rule in rules) else "allow"
        assert (r.rule, r.verdict) == ((best[1], best[0]) if best else (None, mined))


def test_many_parameters(spark):
    """Tokens that always come together are one item: eight parameters cost what one does."""
    from layerwright.llm.url_rules import mine_rules

    url = ["host=a.com", "host=com", "scheme=http", *(f"query={k}" for k in range(8))]
    baskets = [([*url, "dir=x"], True)] * 200 + [(["host=b.com", "host=com", "scheme=http"], False)] * 60 + [(["rare"], True)] * 4
    rows = spark.createDataFrame(baskets, "tokens array<string>, blocked boolean")
    begin = time.perf_counter()
    rules = mine_rules(rows).collect()
    assert time.perf_counter() - begin < 10
    ((tokens, rarest, confidence, _),) = rules
    assert set(tokens) == {*url, "dir=x"} - {"host=com", "scheme=http"} and confidence == 1
    assert rarest in set(tokens)


def test_counts_behind_rules(spark):
    """Support and confidence of each mined rule, by counting baskets."""
    from layerwright.llm.url_rules import mine_rules

    baskets = [(["a", "b"], True)] * 9 + [(["a"], False)] * 5 + [(["b", "c"], True)] * 4 + [(["c"], False)] * 2
    rules = mine_rules(spark.createDataFrame(baskets, "tokens array<string>, blocked boolean"), 0.1, 0.7).collect()
    found = {tuple(r.tokens): (round(r.confidence, 6), round(r.support, 6)) for r in rules}
    want = {}
    for n in (1, 2):
        for combo in combinations("abc", n):
            held = [blocked for tokens, blocked in baskets if set(combo) <= set(tokens)]
            if held and sum(held) / len(baskets) >= 0.1 and sum(held) / len(held) >= 0.7:
                want[combo] = (round(sum(held) / len(held), 6), round(sum(held) / len(baskets), 6))
    least = {c: v for c, v in want.items() if not any(set(o) < set(c) and want[o][0] >= v[0] for o in want)}
    assert found == least
