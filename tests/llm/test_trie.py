"""The conversation trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from brute import WORD, sha

from layerwright.llm.queries import op13_conversation_trie
from layerwright.llm.trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id int, words int"


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """The nodes of rows ``conv_id, turn, role, text``."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for conv, turns in sorted(convs.items()):
        h = zlib.crc32(str(conv).encode()) % 4
        first = convs.get(conv - (abs(conv) % 20 if conv >= 0 else -(abs(conv) % 20)), [])
        new = tuple(first[:h] + turns[h:])
        for depth in range(len(new) + 1):
            members[new[:depth]].append(conv)
        ends[new].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        below = [totals[c] for c in children[node]]
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, convs_in in members.items():
        parent = min(members[node[:-1]]) if node else None
        out.append((convs_in[0], len(node), parent, len(convs_in), len(children[node]), *totals[node], sha(",".join(map(str, ends[node])))))
    return sorted(out, key=str)


def got(df):
    assert dict(df.dtypes) == {
        **dict.fromkeys(["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"], "bigint"),
        "ends_sha256": "string",
    }
    return sorted(map(tuple, df.collect()), key=str)


def run(spark, rows, height=3):
    return got(conversation_trie(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(5), height))


def odd_rows():
    rng = random.Random(11)
    rows = []
    for conv in rng.sample(range(400), 120):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "d  e\tf"])))
    # One conversation with a third of all rows, its twin but for the end, and levels of bands filled to the last place.
    for conv, length in ((500, 200), (1500, 199), (700, 27), (740, 9), (760, 3), (780, 81)):
        rows += [(conv, k, "user", f"w{k % 3} x") for k in range(length)]
    rows += [(conv, 0, "user", "same text") for conv in range(800, 900)]
    rows += [(901, None, None, None), (901, None, "", "late"), (901, 3, "user", None), (902, 1, "a", "b"), (902, 1, "a", "b")]
    rows += [(903, 1, "ab", "c"), (904, 1, "a", "bc"), (-45, 0, "user", "minus"), (-40, 0, "user", "base"), (None, 1, "user", "no id")]
    rows += [(905, k, "user", "long text " * 20_000) for k in range(2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [3, 16])
def test_matches_plain_python(spark, height):
    rows = odd_rows()
    assert run(spark, rows, height) == brute(rows)


def test_empty_and_short(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    # Conversation 9 borrows from an absent one and has nothing of its own left.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    assert run(spark, [(lone, 0, "user", "gone")]) == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


def test_query_matches_plain_python(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got(op13_conversation_trie(spark, sf_dir)) == brute(list(map(tuple, rows)))
