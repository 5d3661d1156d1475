"""Chat formatting as an exact round trip."""

import random
import re
import time

from brute import sha
from pyspark.sql import functions as F

from layerwright.llm.chat import END, format_chats, read_loss, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def run(spark, rows):
    chats = format_chats(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    return chats.select("*", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()


def test_round_trip(spark):
    rng = random.Random(4)
    pieces = ["\\", "<|", "|>", "<", "|", "\n", "<|end|>", "<|next|>", "<|start|>", "<\\|", "é😀", "ok", "</s>", "[INST]", "n"]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(7)))
            role = rng.choice(["user", "assistant", "assistant", "system", "a\nb", "x\\n", "<|end|>", "\\"])
            rows.append((conv, turn, role, text))
    rows += [(500, 1, None, None), (500, 0, "assistant", None), (501, None, "user", "b"), (501, None, "user", "a")]
    rows += [(502, 3, "assistant", "twice"), (502, 3, "assistant", "twice"), (None, 1, "user", "no id")]
    rows += [(503, k, "assistant" if k % 2 else "user", "t" * 50) for k in range(300)]
    rows += [(504, k, "assistant", f"é{k}" * (k % 3)) for k in range(1000)]
    rng.shuffle(rows)
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    got = run(spark, rows)
    assert len(got) == len(want)
    for row in got:
        turns = [t[1:] for t in sorted(want[row.conv_id])]
        assert [tuple(t) for t in row.turns] == turns
        assert row.loss == "".join(t for r, t in turns if r == "assistant")
        masked = [row.formatted[s.start : s.start + s.length] for s in row.loss_spans]
        assert len(masked) == sum(r == "assistant" for r, _ in turns)
        blocks = sum(k == 0 or turns[k - 1][0] != r for k, (r, _) in enumerate(turns))
        assert len(re.findall(re.escape(END), row.formatted)) == blocks


def test_empty(spark):
    assert run(spark, []) == []


def test_query_matches_plain_python(spark):
    from layerwright.llm.queries import op2_chat_formatting

    sf_dir = "/root/testdata/sf0.001"
    want = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    rows = op2_chat_formatting(spark, sf_dir).collect()
    assert len(rows) == len(want)
    for r in rows:
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_cost_follows_turns(spark):
    """Twice the turns take at most 2.5 times as long."""
    def seconds(turns):
        rows = spark.range(turns).selectExpr(
            "id % 1 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "repeat('ab<|é', 20) AS text"
        )
        best = float("inf")
        for _ in range(2):
            begin = time.perf_counter()
            chats = format_chats(rows).select(F.col("conv_id"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
            got = chats.select(F.length("loss")).first()[0]
            best = min(best, time.perf_counter() - begin)
            assert got == turns // 2 * 100
        return best

    seconds(1000)
    assert seconds(32000) <= 2.5 * seconds(16000)
