"""URL filtering: fixed host and path rules first, mined association rules for the rest.

Tokens are parts of a URL: host suffixes, path folders, the file ending, names of query parameters and the scheme.  Tokens
that occur in the same labelled URLs are one item.  Spark's FP-growth mines combinations of items from labelled URLs together
with their label.  Rules ``tokens -> block`` are pruned by support and confidence, by dropping combinations that part of
their items implies, and by dropping rules no better than one with fewer items.  To match, every rule is filed under its
rarest token in an inverted index; a URL meets a rule through that token and must hold all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import removed, stored

BLOCKED = "label=block"
# Part of the labelled URLs a combination must occur in, and of its URLs that must be blocked.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
# Labelled URLs a combination must occur in, however few there are.
MIN_ROWS = 5


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a text without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, with their kind in front."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.lit("host="), F.array_join(F.slice(labels, n, F.size(labels)), ".")),
    )
    folders = F.split(path, "/")
    folders = F.transform(F.slice(folders, 1, F.greatest(F.size(folders) - 1, F.lit(0))), lambda p: F.concat(F.lit("dir="), p))
    ending = F.array(F.concat(F.lit("ending="), F.regexp_extract(path, r"(?s)\.([A-Za-z0-9]+)\z", 1)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.concat(F.lit("query="), F.substring_index(p, "=", 1)))
    scheme = F.array(F.concat(F.lit("scheme="), lower_ascii(F.substring_index(F.coalesce(url, F.lit("")), "://", 1))))
    known = F.filter(F.concat(suffixes, folders, ending, names), lambda t: ~F.endswith(t, F.lit("=")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(known, scheme)))


def same_items(labelled: DataFrame, least: int) -> DataFrame:
    """``item, members, n``: tokens of at least ``least`` rows of ``tokens``, those of exactly the same rows as one item.

    Which rows hold a token is told by two hashes over the distinct baskets with it.
    """
    baskets = labelled.groupBy(F.array_sort("tokens").alias("basket")).agg(F.count("*").alias("n"))
    marks = [F.xxhash64(F.lit(seed), "basket").alias(f"mark{seed}") for seed in (1, 2)]
    seen = baskets.select(F.explode("basket").alias("token"), "n", *marks).groupBy("token")
    seen = seen.agg(F.sum("n").alias("n"), F.bit_xor("mark1").alias("mark1"), F.bit_xor("mark2").alias("mark2"))
    alike = seen.where(F.col("n") >= least).groupBy("n", "mark1", "mark2")
    members = alike.agg(F.sort_array(F.collect_list("token")).alias("members"))
    return members.select(F.col("members")[0].alias("item"), "members", "n")


def without(items: Column, item: Column) -> Column:
    return F.filter(items, lambda i: i != item)


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Rules ``tokens, rarest, confidence, support`` for blocking, mined from ``tokens, blocked``.

    A combination needs ``min_support`` of the labelled rows and ``min_rows`` of them.  ``min_support`` bounds the number
    of frequent tokens by its inverse times the tokens of a URL, whatever the table, and so the items the driver names to
    FP-growth and the table of rules.  A rule holds all tokens of its items; ``rarest`` is one of the fewest rows.  A
    combination is dropped if leaving an item out keeps the same rows (this also drops items that another implies), a
    rule if part of its items make a rule at least as confident.  Without labelled rows there are no rules.
    """
    spark = labelled.sparkSession
    labelled = labelled.where("blocked IS NOT NULL")
    rows = labelled.count()
    least = max(math.ceil(min_support * rows), min_rows, 1)
    # FP-growth rounds the share up to rows again; above 1 no combination reaches it.
    support = min((least - 0.5) / max(rows, 1), 1.0)
    items, items_path = stored(same_items(labelled, least), "items")
    names = [r.item for r in items.select("item").collect()]
    kept = F.array_intersect("tokens", F.array(*map(F.lit, names)).cast("array<string>"))
    baskets = labelled.select(F.when(F.col("blocked"), F.array_append(kept, F.lit(BLOCKED))).otherwise(kept).alias("items"))
    mined = FPGrowth(itemsCol="items", minSupport=support).fit(baskets).freqItemsets
    sets, sets_path = stored(mined.select(F.sort_array("items").alias("items"), "freq"), "itemsets")
    blocking = F.array_contains("items", BLOCKED)
    hits = sets.where(blocking).select(without(F.col("items"), F.lit(BLOCKED)).alias("items"), F.col("freq").alias("hits"))
    plain = sets.where(~blocking)
    # A combination as frequent as one with an item less is implied by it.
    fewer = plain.where("size(items) > 1").select("items", F.col("freq").alias("n"), F.explode("items").alias("item"))
    fewer = fewer.select(F.col("items").alias("larger"), "n", without(F.col("items"), F.col("item")).alias("items"))
    implied = fewer.join(plain, "items").where("freq = n").select(F.col("larger").alias("items")).distinct()
    rules = plain.join(implied, "items", "left_anti").join(hits, "items")
    sure = (F.col("hits") / F.col("freq")).alias("confidence")
    rules = rules.select("items", sure, (F.col("hits") / rows).alias("support")).where(F.col("confidence") >= min_confidence)
    rules, rules_path = stored(rules, "rules")
    none = F.array(F.array().cast("array<string>"))
    subsets = F.aggregate("items", none, lambda all, i: F.concat(all, F.transform(all, lambda s: F.array_append(s, i))))
    parts = rules.select("items", "confidence", F.explode(subsets).alias("part")).where("size(part) < size(items)")
    better = rules.select(F.col("items").alias("part"), F.col("confidence").alias("as_sure"))
    beaten = parts.join(better, "part").where("as_sure >= confidence").select("items").distinct()
    best = rules.join(beaten, "items", "left_anti")
    spelled = best.select("*", F.explode("items").alias("item")).join(items, "item")
    spelled = spelled.groupBy("items", "confidence", "support").agg(
        F.sort_array(F.flatten(F.collect_list("members"))).alias("tokens"),
        F.min_by("item", F.struct("n", "item")).alias("rarest"),
    )
    spelled, _ = stored(spelled.select("tokens", "rarest", "confidence", "support"), "mined")
    removed(spark, items_path, sets_path, rules_path)
    return spelled


def mined_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The ids (``key``) of URLs with ``key, tokens`` that some rule blocks, with the best confidence.

    Rules are filed under their rarest token; a token's postings are met by that token's URLs only.
    """
    index = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("rule"), "confidence")
    posted = urls.select("key", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    held = posted.where(F.size(F.array_except("rule", "tokens")) == 0)
    return held.groupBy("key").agg(F.max("confidence").alias("confidence"))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule ``(verdict, host, path)`` that fits; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    text = verdict = None
    for kind, at, begin in ordered:
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(begin))
        text = F.when(fits, at + begin) if text is None else text.when(fits, at + begin)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (text, verdict) if text is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence``: allow or block for every row of ``pages``.

    ``labels`` has ``page_id, blocked``; several labels of one page count as blocked if any is.  Needs ``page_id`` and
    ``url``; other columns, whatever their names, are not read.  A null URL, or one without ``://``, has an empty host
    and path, fits no rule and is allowed.  Pages without a fitting fixed rule are blocked if a mined rule holds for
    them, else allowed.  Rows with a null id are judged too; rows with equal ids each by their own URL.  Without
    labelled URLs nothing is mined.  An empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path"))
    marked = labels.groupBy("page_id").agg(F.max("blocked").alias("blocked"))
    labelled = parts.where("host <> ''").join(marked, "page_id").select(tokens.alias("tokens"), "blocked")
    mined = mine_rules(labelled, min_support, min_confidence, min_rows)
    text, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumns({"rule": text, "fixed": verdict})
    # Equal URLs are judged once; a URL is its own key.
    urls = judged.where("fixed IS NULL AND host <> ''").select("url", "host", "path").distinct()
    blocked = mined_verdicts(urls.select(F.col("url").alias("key"), tokens.alias("tokens")), mined)
    # Rows that need no mined verdict meet nothing: their keys, which hold no "://", only spread them over the tasks.
    needs = F.col("fixed").isNull() & (F.col("host") != "")
    judged = judged.withColumn("asks", F.when(needs, F.col("url")).otherwise(F.xxhash64("page_id", "url").cast("string")))
    judged = judged.join(blocked, judged.asks == blocked.key, "left")
    verdict = F.coalesce("fixed", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    sure = F.when(F.col("fixed").isNull(), F.col("confidence")).alias("confidence")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), sure)
