"""Packing as an exact round trip through the tokenizer."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from layerwright.llm import packing
from layerwright.llm.packing import packed_sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(spark, rows, capacity, partitions):
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, ids string")
    pieces = packed_sequences(table.repartition(partitions), PATH, capacity).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows)
    sequences = defaultdict(list)
    by_doc = defaultdict(dict)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id][p.start] = p
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    got = []
    for parts in by_doc.values():
        ids = b"".join(bytes(parts[s].ids) for s in sorted(parts))
        got.append(np.frombuffer(ids, "<u4").tolist())
        assert all(p.doc_tokens == len(got[-1]) for p in parts.values())
        assert [s for s in sorted(parts)] == np.cumsum([0] + [parts[s].length for s in sorted(parts)][:-1]).tolist()
    assert sorted(got) == want
    return sequences


@pytest.mark.parametrize("capacity, partitions, remembered", [(4096, 1, 1 << 20), (64, 5, 1 << 20), (1024, 2, 3000)])
def test_round_trip(spark, monkeypatch, capacity, partitions, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    monkeypatch.setattr(packing, "SLICE_BYTES", 50 * remembered)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    odd = [None, "", " \n", "a", "İstanbul Σίσυφος ﬁ éx  nbsp em", "x" * 3000, "don't 12,345 <|endoftext|> ok", "a\x1cb \x85c​d"]
    odd += ["H̱ J̌ Ẅ İ İ Éa E\u0301. a.\u0301b A.B,c;D'S.'s don't.'ll X.! ?", "ΑΣ. ΣA. aΣ.b K. ſ. A≯. B<\u0338", "J\u030c. I\u0307"]
    odd += ["a.b.c,D;e", "Z\u036f.", "<|endoftext|>. x<|padding|>.Y", "<|ENDOFTEXT|>. X.", "A.<|EndOfText|>B.<|startoftext|>", "WORD.WORD! Word? wOrd: 3.5.A"]
    odd += ["😀 👩‍👩‍👧 日本語テキスト", " ́lone mark", "word " * 5000]
    sequences = check(spark, list(enumerate(texts + odd)), capacity, partitions)
    short = [s for s in sequences.values() if sum(n for _, n in s) < capacity]
    assert len(short) <= partitions * capacity.bit_length()


def test_few_pieces_and_no_bare_ends(spark):
    """Beyond full sequences fewer than two pieces a document, whole ones k to a bin, and no sequence of ends alone."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").coalesce(2)
    pieces = packed_sequences(rows, PATH).collect()
    docs = len({p.doc_id for p in pieces})
    cut = [p for p in pieces if p.length < 4096]
    assert len(cut) <= 2 * docs
    whole = [p for p in cut if p.start % 4096 == 0 and p.start + p.length == p.doc_tokens]
    assert len(whole) >= docs // 2
    text = defaultdict(int)
    for p in pieces:
        text[p.sequence_id] += sum(k != 2 for k in np.frombuffer(p.ids, "<u4"))
    assert min(text.values()) > 0


@pytest.mark.parametrize("lengths", [[3000] * 50, [1] * 9000, [2049, 1, 1, 5000] * 30, [4096, 8192, 4097], [63, 64, 65] * 300])
def test_bins(lengths):
    """Any mix of lengths: all tokens once, sequences full but for powers of two at the end."""
    bins = packing.Bins(4096, 0)
    for k, n in enumerate(lengths):
        bins.add(k, np.arange(n, dtype=np.uint32))
    bins.finish()
    sizes, starts = defaultdict(int), defaultdict(dict)
    for doc_id, start, length, ids, total, sequence, offset in bins.rows:
        assert offset == sizes[sequence] and total == lengths[doc_id]
        assert np.frombuffer(ids, np.uint32).tolist() == list(range(start, start + length))
        sizes[sequence] += length
        starts[doc_id][start] = length
    assert all(n <= 4096 and n & (n - 1) == 0 for n in sizes.values())
    assert sum(n < 4096 for n in sizes.values()) <= 12
    for k, n in enumerate(lengths):
        at = 0
        while at < n:
            at += starts[k][at]
        assert at == n
    assert sum(p[2] < 4096 for p in bins.rows) <= 2 * len(lengths) + 12


def test_empty(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert packed_sequences(table, PATH).collect() == []
    row = packed_sequences(spark.createDataFrame([(None, None)], "doc_id long, text string"), PATH).first()
    assert tuple(row) == (None, 0, 1, b"\x02\0\0\0", 1, row.sequence_id, 0)


def test_capacity_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packed_sequences(spark.createDataFrame([], "doc_id long, text string"), PATH, 1000)
