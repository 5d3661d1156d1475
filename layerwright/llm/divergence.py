"""How far the sources of a language differ in their terms, which move once to be counted.

Tasks cut texts into terms and list, per language and term, the counts of each source; these rows are shuffled once, with
the term's spelling, and summed where they arrive.  A 64-bit digest then takes the place of a kept term; terms of one
language that share a digest are told apart by their spelling.  Only terms that get into the result are spelled out again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import small_batches, stored
from .words import coded_words, slices, split_words, text_units, tidy, whole

# Text counted at a time.
PIECE_BYTES = 24 << 20
SCALE = 1_000_000_000
# Bytes of terms are letters and everything beyond ASCII; A-Z are lower-cased.
TERM_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
COUNTED = "lang string, term string, spread array<struct<source:string,n:bigint,docs:bigint>>"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of letters and non-ASCII characters, and where each text's terms begin."""
    data, bounds = text_units(texts)
    plain = pa.StringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(TERM_BYTES[data])
    )
    return split_words(plain)


def summed(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct keys and the sum of each column over each of them."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.append(np.ones(min(len(keys), 1), bool), ordered[1:] != ordered[:-1]))
    return [ordered[first], *[np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns]]


def counted_terms(piece: pa.Table) -> pa.RecordBatch:
    """Rows of ``COUNTED`` for some documents: per language and term the occurrences ``n`` and the documents of each source
    that has it, and per language, under no term, all its sources."""
    values, bounds = terms_of(whole(piece["text"]))
    codes, distinct = coded_words(values)
    names = [whole(piece[c]).dictionary_encode() for c in ("lang", "source")]
    lang, source = (n.indices.to_numpy(zero_copy_only=False).astype(np.int64) for n in names)
    wide, size = max(len(names[1].dictionary), 1), len(distinct) + 1
    documents = np.repeat(np.arange(piece.num_rows), np.diff(bounds))
    in_document, n = summed(documents * size + codes, np.ones(len(codes), np.int64))
    document, code = in_document // size, in_document % size
    # The last code stands for no term.
    found = ((lang[document] * size + code) * wide + source[document], (lang * size + size - 1) * wide + source)
    none = np.zeros(piece.num_rows, np.int64)
    keys, n, docs = summed(np.concatenate(found), np.append(n, none), np.append(np.ones(len(n), np.int64), none))
    rows = keys // wide
    first = np.flatnonzero(np.append(np.ones(min(len(rows), 1), bool), rows[1:] != rows[:-1]))
    spread = pa.StructArray.from_arrays(
        [names[1].dictionary.take(pa.array(keys % wide)), pa.array(n), pa.array(docs)], ["source", "n", "docs"]
    )
    code = rows[first] % size
    return pa.RecordBatch.from_arrays(
        [
            names[0].dictionary.take(pa.array(rows[first] // size)),
            distinct.take(pa.array(code, mask=code == size - 1)),
            pa.ListArray.from_arrays(pa.array(np.append(first, len(rows)).astype(np.int32)), spread),
        ],
        ["lang", "term", "spread"],
    )


@tidy
def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", PIECE_BYTES):
            kept.append(part)
            size += pc.sum(pc.binary_length(part["text"])).as_py() or 0
            if size >= PIECE_BYTES:
                yield counted_terms(pa.concat_tables(kept))
                kept, size = [], 0
    if kept:
        yield counted_terms(pa.concat_tables(kept))


def exact(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,0))"


def share(count: str, total: str, terms: str) -> str:
    """A count as a share, one added to each count, in parts of 10^9 and never 0; decimals only where longs overflow."""
    wide = f"({exact(SCALE)} * ({count} + 1)) div {exact(f'{total} + {terms}')}"
    return f"(1 + CASE WHEN {count} < 9000000000 THEN ({SCALE}L * ({count} + 1)) div ({total} + {terms}) ELSE {wide} END)"


def gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def times(value: str, count: str) -> Column:
    """The sum of products, exactly, added in two parts of nine digits and the rest."""
    high, low = (F.sum(F.expr(f"{count} * ({value} {part} {SCALE}L)")) for part in ("div", "%"))
    return F.coalesce(high.cast("decimal(38,0)") * SCALE + low, F.lit(0)).cast("decimal(38,0)")


def kept_terms(documents: DataFrame, least_docs: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms ``lang, digest, split, term, total, spread`` and all groups ``lang, source``.

    ``spread`` lists ``source, n`` of a term, ``split`` is the term itself where its digest stands for several, else empty.
    """
    small_batches(documents.sparkSession)
    texts = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # The rows of a term meet once: both sums over it find them in one place.
    counts = texts.mapInArrow(counted, COUNTED).repartition("lang", "term").select("lang", "term", F.inline("spread"))
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("spread")
    )
    kept, _ = stored(counts.where(f"term IS NULL OR docs >= {least_docs}").drop("docs"), "audit-terms")
    groups = kept.where("term IS NULL").select("lang", F.explode("spread.source").alias("source"))

    digest = F.shiftrightunsigned(F.xxhash64("term"), 64 - bits).alias("digest")
    terms = kept.where("term IS NOT NULL").select("lang", digest, "term", "total", "spread")
    several = terms.groupBy("lang", "digest").agg(F.count("*").alias("several")).where("several > 1")
    split = F.lit("")
    if not several.isEmpty():
        terms = terms.join(several, ["lang", "digest"], "left")
        split = F.expr("CASE WHEN several > 1 THEN term ELSE '' END")
    return terms.select("lang", "digest", split.alias("split"), "term", "total", "spread"), groups


def totals(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group ``lang, source`` its kept occurrences ``in_group``, and its language's ``in_lang`` and ``terms``."""
    spread = terms.select("lang", F.explode("spread").alias("x")).select("lang", "x.*")
    own = spread.groupBy("lang", "source").agg(F.sum("n").alias("in_group"))
    langs = terms.groupBy("lang").agg(F.sum("total").alias("in_lang"), F.count("*").alias("terms"))
    joined = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    return joined.na.fill(0, ["in_group", "in_lang", "terms"])


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the gap between every two sources of a language over all its kept terms.

    A gap depends on the two counts only, so terms are grouped by them.  Terms that occur in one source of the two, or
    in none, are not listed pair by pair: they follow from how many terms have each count in each source.
    """
    ends = groups.select("lang", F.col("source").alias("item"), F.col("in_group").alias("in_item"))
    pairs = groups.join(ends, "lang").where("source <> item").select("lang", "source", "item", "in_group", "in_item", "terms")
    p, q = share("0L", "in_group", "terms"), share("0L", "in_item", "terms")
    pairs, _ = stored(pairs.withColumn("p", F.expr(p)).withColumn("q", F.expr(q)), "audit-pairs")
    key = ["lang", "source", "item"]

    spread = terms.select("lang", F.explode("spread").alias("x"), "spread")
    alone = spread.groupBy("lang", F.col("x.source").alias("source"), F.col("x.n").alias("a")).agg(F.count("*").alias("m"))
    alone, _ = stored(alone, "audit-alone")
    both = spread.select("lang", "x.source", F.col("x.n").alias("a"), F.explode("spread").alias("y"))
    both = both.select("lang", "source", F.col("y.source").alias("item"), "a", F.col("y.n").alias("b"))
    both = both.where("source < item").groupBy(*key, "a", "b").agg(F.count("*").alias("m"))
    ways = F.array(
        F.struct(F.col("source"), F.col("item"), F.col("a"), F.col("b")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("b").alias("a"), F.col("a").alias("b")),
    )
    both = both.select("lang", F.explode(ways).alias("w"), "m").select("lang", "w.*", "m")

    p_a, q_b = F.expr(share("a", "in_group", "terms")), F.expr(share("b", "in_item", "terms"))
    neither, first, second = gap("p", "q"), gap("pa", "q"), gap("p", "qb")
    extra = f"({gap('pa', 'qb')} - {first} - {second} + {neither})"
    both = both.join(pairs, key).withColumn("pa", p_a).withColumn("qb", q_b)
    in_first = pairs.join(alone, ["lang", "source"]).withColumn("pa", p_a)
    in_second = pairs.join(alone.withColumnsRenamed({"source": "item", "a": "b"}), ["lang", "item"]).withColumn("qb", q_b)
    # As if all terms were in neither; then what each term in one of the two changes; then what being in both adds.
    parts = [
        pairs.select(*key, F.expr(f"{exact(neither)} * terms").cast("decimal(38,0)").alias("value")),
        in_first.groupBy(*key).agg(times(f"({first} - {neither})", "m").alias("value")),
        in_second.groupBy(*key).agg(times(f"({second} - {neither})", "m").alias("value")),
        both.groupBy(*key).agg(times(extra, "m").alias("value")),
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.groupBy(*key).agg(F.sum("value").cast("bigint").alias("value"))


def leading_terms(terms: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """``lang, source, item, value``: terms a source uses more than its language, at least those of the first ranks."""
    spread = terms.select("lang", "digest", "split", "total", F.explode("spread").alias("x"))
    spread = spread.select("lang", "digest", "split", "total", "x.source", "x.n").join(groups, ["lang", "source"])
    spread = spread.withColumn("p", F.expr(share("n", "in_group", "terms")))
    spread = spread.withColumn("q", F.expr(share("total", "in_lang", "terms"))).where("p > q")
    valued = spread.select("lang", "source", "digest", "split", F.expr(gap("p", "q")).alias("value"))
    valued, _ = stored(valued, "audit-values")
    # Fewer rows than the ranks leave a map task per group; ties with the last of them are spelled out too.
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    first = valued.withColumn("r", F.row_number().over(by_value)).where(f"r <= {ranks}")
    least = first.groupBy("lang", "source").agg(F.min("value").alias("least"))
    leading = valued.join(least, ["lang", "source"]).where("value >= least")
    leading, _ = stored(leading.drop("least"), "audit-leading")
    spelled = terms.select("lang", "digest", "split", F.col("term").alias("item"))
    return leading.join(spelled, ["lang", "digest", "split"]).select("lang", "source", "item", "value")


def source_divergence(documents: DataFrame, least_docs: int = 3, ranks: int = 200, bits: int = 64) -> DataFrame:
    """One row per ``lang, source, part, item`` with ``value`` and ``rank``.

    Part ``pair`` compares a source of a language with each other one, part ``term`` lists the terms that it uses more
    than its language.  Needs ``lang, source, text``, null being empty; other columns, whatever their names, are not
    read.  A language keeps the terms that occur in ``least_docs`` of its rows; repeated rows are documents of their
    own.  A group without terms takes part with counts of 0; a language without kept terms has pairs of value 0.  Ranks
    go by value, then by the item's bytes.  No rows give no rows.  ``bits`` is the width of the digests.
    """
    terms, groups = kept_terms(documents, least_docs, bits)
    groups, _ = stored(totals(terms, groups), "audit-totals")
    pair = source_pairs(terms, groups).withColumn("part", F.lit("pair"))
    term = leading_terms(terms, groups, ranks).withColumn("part", F.lit("term"))

    by_rank = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    rank = F.row_number().over(by_rank).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return pair.select(*columns, rank).unionByName(term.select(*columns, rank).where(f"rank <= {ranks}"))
