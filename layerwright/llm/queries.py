"""The registered queries of this package: each applies one operator to a whole table with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import substring_dedup
from .chat import format_chats, read_loss, read_turns
from .contamination import decontaminated
from .cover import embedding_duplicates
from .divergence import source_divergence
from .language import fit_languages, fold, identified
from .minhash import near_duplicates
from .mixing import mixed
from .packing import packed_sequences
from .prefix_free import suffix_dedup
from .recurrent import language_scores
from .trie import conversation_trie
from .url_rules import judge_urls

# The URL rules of op5 as verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their 3-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds control strings of other templates, formatted and read back."""
    control = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(
        "SELECT -7L AS conv_id, turn, role, text FROM VALUES (0L, 'user', :text), (1L, 'assistant', :text)"
        " AS t (turn, role, text)",
        args={"text": control},
    )
    chats = format_chats(rows.unionByName(added))
    back = chats.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens in sequences of 4096."""
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packed_sequences(table(spark, sf_dir, "documents"), path, capacity=4096, end=2)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing 50-word runs of documents with smaller ids, as a digest."""
    result = substring_dedup(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the fixed rules, else by rules mined from labels: poor or toxic is to be blocked."""
    labels = table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS page_id", "coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS blocked"
    )
    judged = judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of the ids."""
    documents = table(spark, sf_dir, "documents")
    model = fit_languages(documents.where(fold(3) != 1))
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return identified(documents, model).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine of 0.93 or more."""
    return embedding_duplicates(table(spark, sf_dir, "embeddings"), similarity=0.93)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by how much of them lies in 13-word windows of benchmark items."""
    result = decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, percent=5)
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left after removing 50-byte strings of documents with smaller ids, as a digest."""
    result = suffix_dedup(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of every document, learned from four fifths of the ids."""
    held_out = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 1"
    return language_scores(table(spark, sf_dir, "documents"), held_out)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ from one another, and the terms that set them apart."""
    return source_divergence(table(spark, sf_dir, "documents"), least_docs=3, ranks=200)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix by source weights takes."""
    mix = mixed(table(spark, sf_dir, "documents"), weights=(5, 2, 1), percent=150, most=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations rebuilt to share beginnings, with totals of every subtree."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_chat_formatting,
        op3_harmonic_packing,
        op4_substring_dedup,
        op5_url_filter,
        op6_language_id,
        op7_embedding_near_dedup,
        op8_benchmark_decontamination,
        op9_suffix_dedup,
        op10_lm_scoring,
        op11_source_divergence,
        op12_source_mix,
        op13_conversation_trie,
    )
}
ORACLES: dict[str, str] = {
    "op2_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), laid AS (
            SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS safe,
                replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS safe_role,
                role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS first
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
                AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
                AS loss_sha256,
            CAST(sum(length(safe) + CASE WHEN first THEN length('<|start|>') + length(safe_role) + 1
                + length('<|end|>') + 1 ELSE length('<|next|>') END) AS BIGINT) AS formatted_chars
        FROM laid GROUP BY conv_id
    """,
    "op11_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), found AS (
            SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ), kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT doc) >= 3
        ), counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL
        ), groups AS (
            SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(sum(n), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM docs) AS g LEFT JOIN vocabulary USING (lang)
            LEFT JOIN counts USING (lang, source) GROUP BY ALL
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
                1 + (1000000000 * (coalesce(n, 0) + 1)::HUGEINT) // (g.total + g.v) AS p
            FROM groups AS g JOIN kept AS k USING (lang) LEFT JOIN counts AS c USING (lang, source, term)
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                CAST(coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS BIGINT) AS value
            FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN shares AS x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN shares AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL
        ), languages AS (
            SELECT *, sum(n) OVER (PARTITION BY lang) AS total
            FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term)
        ), terms AS (
            SELECT s.lang, s.source, 'term' AS part, s.term AS item, s.p,
                1 + (1000000000 * (l.n + 1)::HUGEINT) // (l.total + v.v) AS q
            FROM shares AS s JOIN languages AS l USING (lang, term) JOIN vocabulary AS v USING (lang) WHERE s.n > 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (
                SELECT * FROM pairs UNION ALL
                SELECT lang, source, part, item, CAST((p - q) * (p - q) // q AS BIGINT) FROM terms WHERE p > q)
        )
        SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
    "op12_source_mix": r"""
        WITH sizes AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size) AS source_size,
                [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight
            FROM sizes GROUP BY source
        ), lined AS (
            SELECT *, 3 * sum(source_size) OVER () - 4 * (sum(source_size) OVER up - source_size) AS left_2,
                sum(weight) OVER () - (sum(weight) OVER up - weight) AS rest
            FROM sources WINDOW up AS (ORDER BY source_size / weight, source NULLS LAST)
        ), stops AS (SELECT *, 4 * source_size * rest < left_2 * weight AS stops FROM lined
        ), shared AS (
            SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) FILTER (stops) OVER (), 0) AS shared_2,
                sum(weight) FILTER (NOT stops) OVER () AS heft
            FROM stops
        ), targets AS (
            SELECT source, source_size,
                CASE WHEN stops THEN CAST(2 * source_size AS DOUBLE)
                    ELSE CAST(shared_2 * weight * 50 AS DOUBLE) / CAST(100 * heft AS DOUBLE) END AS target,
                CASE WHEN source_size = 0 THEN 0 WHEN stops THEN 2 * 1099511627776
                    ELSE (CAST(shared_2 AS HUGEINT) * weight * 50 * 1099511627776) // (source_size * 100 * heft) END AS per_copy,
                CAST(concat('0x', substr(md5(CASE WHEN source IS NULL THEN '0' ELSE concat('0:', source) END), 1, 10)) AS BIGINT)
                    AS start
            FROM shared
        ), lines AS (
            SELECT s.*, CAST(row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) AS HUGEINT) AS place
            FROM sizes AS s
        )
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
            CAST(size * ((per_copy * place + start) // 1099511627776 - (per_copy * (place - 1) + start) // 1099511627776)
                AS BIGINT) AS taken
        FROM lines JOIN targets ON lines.source IS NOT DISTINCT FROM targets.source
    """,
    "op13_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
            FROM conversations WHERE conv_id IS NOT NULL
        ), lengths AS (
            SELECT conv_id, count(*) AS own, xor(4294967295, list_reduce(
                list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                lambda c, b: list_reduce(range(8),
                    lambda d, k: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END, xor(c, b)),
                4294967295)) % 4 AS h
            FROM turns GROUP BY conv_id
        ), conversations_now AS (
            SELECT a.conv_id, a.conv_id - a.conv_id % 20 AS first_id, a.h, least(a.h, coalesce(b.own, 0)) AS lent
            FROM lengths AS a LEFT JOIN lengths AS b ON b.conv_id = a.conv_id - a.conv_id % 20
        ), rebuilt AS (
            SELECT c.conv_id, t.i AS depth, role, text FROM conversations_now AS c JOIN turns AS t
                ON t.conv_id = c.first_id AND t.i <= c.h
            UNION ALL
            SELECT c.conv_id, lent + i - h, role, text FROM conversations_now AS c JOIN turns USING (conv_id) WHERE i > h
        ), paths AS (
            SELECT conv_id, depth, text, string_agg(concat(length(role), ':', role, length(text), ':', text), '')
                OVER (PARTITION BY conv_id ORDER BY depth) AS path
            FROM rebuilt
            UNION ALL SELECT conv_id, 0, '', '' FROM lengths
        ), stepped AS (
            SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
                lead(path) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS is_end FROM paths
        ), nodes AS (
            SELECT path, parent, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs,
                (count(*) - 1) * len(regexp_extract_all(min(text), '[^\x20\x09-\x0D]+')) AS saved,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
            FROM stepped GROUP BY path, parent
        ), counted AS (
            SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes AS c WHERE c.parent = n.path) AS n_children
            FROM nodes AS n LEFT JOIN nodes AS p ON p.path = n.parent
        )
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, n.parent_conv_id, n.n_convs, n.n_children,
            count(*) FILTER (u.n_children = 0) AS n_leaves, CAST(sum(u.saved) AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM counted AS n JOIN counted AS u ON starts_with(u.path, n.path)
        GROUP BY n.path, n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256
    """,
}
