"""Mixing sources to target weights by systematic sampling, with Spark expressions only.

Every document of a source is expected in the mix the same number of times, the source's target over its size.  Lining
the documents up and adding a random offset, a document is taken once for every whole number that the running sum of
expected copies passes inside it.  The line is ordered by size, so what is taken and what is left alternate among
documents of about one size: the words taken differ from the target by less than the source's longest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import ranged_sums
from .tables import stored

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
# Expected copies and the offset are counted in parts of 2^-40.
PARTS = 1 << 40
# Equal rows placed by one task.
BLOCK = 1 << 16


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null text has none.  Needs no array of the words."""
    marks = F.translate(F.regexp_replace(text, WORD, "x"), SPACES, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """``source, source_size, target, per_copy``: what each source should give, of rows ``source, size``.

    ``per_copy`` is the number of expected copies of each of its documents in parts of 2^-40.  Sources in code point
    order, null last, take ``weights`` in turn and share ``percent`` of all sizes; a target stops at ``most`` times
    its source's size, and the rest is shared again among the others until none is above.
    """
    per_source, _ = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ordered = ranged_sums(per_source.withColumn("one", F.lit(1)), [], [F.col("source").asc_nulls_last()], "one", "mix-order")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    ordered = ordered.select("source", "source_size", weight.cast("bigint").alias("weight"))
    table, _ = stored(ordered, "mix-weights")
    number = "CAST({} AS DECIMAL(38,0))".format
    total, heft = table.agg(F.sum("source_size"), F.sum("weight")).first()
    left, rest = percent * int(total or 0), int(heft or 0)
    while True:
        stops = f"{number('source_size')} * {100 * most * rest} < {number(left)} * weight"
        size, stopped = table.where(stops).agg(F.sum("source_size"), F.sum("weight")).first()
        after = percent * int(total or 0) - 100 * most * int(size or 0), int(heft or 0) - int(stopped or 0)
        if after == (left, rest):
            break
        left, rest = after
    share = f"{number(left)} * weight"
    target = f"CASE WHEN {stops} THEN CAST({most} * source_size AS DOUBLE) ELSE CAST({share} AS DOUBLE) / {100 * rest}D END"
    copies = (
        f"CASE WHEN source_size = 0 THEN 0L WHEN {stops} THEN {most * PARTS}L"
        f" ELSE ({number(share)} * {number(PARTS)}) div ({number('source_size')} * {100 * rest}) END"
    )
    return table.select("source", "source_size", F.expr(target).alias("target"), F.expr(copies).alias("per_copy"))


def mixed(
    documents: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 150, most: int = 2, seed: int = 0
) -> DataFrame:
    """One row per document: ``doc_id, source, mark, size, source_size, target, copies, taken``.

    Needs ``doc_id, text, source``; other columns, whatever their names, are not read.  ``size`` counts words (null or
    empty text: 0) and ``taken`` is ``copies * size``; ``mark`` is a hash of the text, see :func:`emitted`.  Documents
    without words are expected as often as the others of their source, if that has words at all.  A null source is a
    source of its own, a null id an id like others, before all of them.  The line of a source is ordered by size, id
    and text; equal rows follow each other, and each is a document of its own.  The offset depends on ``seed`` and
    source only: the same rows, in any order and layout, give the same mix.  No rows give no rows.
    """
    spark = documents.sparkSession
    sizes = documents.select("doc_id", "source", F.xxhash64("text").alias("mark"), word_count(F.col("text")).alias("size"))
    sizes, _ = stored(sizes, "mix-sizes")
    targets, _ = stored(source_targets(sizes, weights, percent, most), "mix-targets")
    equal, _ = stored(sizes.groupBy("source", "size", "doc_id", "mark").agg(F.count("*").alias("n")), "mix-equal")
    order = [F.col(c).asc() for c in ("size", "doc_id", "mark")]
    placed, _ = stored(ranged_sums(equal, ["source"], order, "n", "mix-ranges"), "mix-places")
    repeated = placed.where("n > 1")
    blocks = repeated.withColumn("block", F.expr(f"explode(sequence(0L, (n - 1) div {BLOCK}))"))
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "mark", "block")
    one = F.expr(f"explode(sequence(block * {BLOCK}, least((block + 1) * {BLOCK}, n) - 1))")
    each = blocks.withColumn("k", one).withColumn("before", F.col("before") + F.col("k")).drop("block", "k")
    lines = placed.where("n = 1").unionByName(each)
    targets = targets.withColumnRenamed("source", "target_source")
    lines = lines.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
    name = f"md5(CASE WHEN source IS NULL THEN '{seed}' ELSE concat('{seed}:', source) END)"
    offset = f"CAST(conv(substr({name}, 1, 10), 16, 10) AS DECIMAL(18,0))"
    passed = f"(CAST({{}} AS DECIMAL(19,0)) * CAST(per_copy AS DECIMAL(18,0)) + {offset}) div {PARTS}"
    copies = F.expr(f"{passed.format('before + 1')} - {passed.format('before')}").alias("copies")
    lines = lines.select("doc_id", "source", "mark", "size", "source_size", "target", copies)
    return lines.withColumn("taken", F.col("copies") * F.col("size"))


def emitted(documents: DataFrame, mix: DataFrame) -> DataFrame:
    """The mix itself: ``doc_id, source, text, copy``, every document of :func:`mixed` once per copy, from 1.

    Equal rows of ``documents`` are counted together.  Documents without a copy are left out.
    """
    keys = ["doc_id", "source", "mark"]
    wanted = mix.groupBy(*keys).agg(F.sum("copies").alias("copies")).where("copies > 0")
    wanted = wanted.select(*[F.col(k).alias(f"wanted_{k}") for k in keys], "copies")
    texts = documents.select("doc_id", "source", "text", F.xxhash64("text").alias("mark")).dropDuplicates(keys)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"wanted_{k}"))
    return texts.join(wanted, same).select("doc_id", "source", "text", F.expr("explode(sequence(1L, copies))").alias("copy"))
