"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    filter_audit,
    html_text,
    mixing,
    neighbours,
    packing,
    personal,
    prefix_trie,
    quality,
    sharding,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from tributary.llm.tables import read
from tributary.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL that gives the same rows, where SQL can.
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = quality.fit_rules(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagger = personal.fit_tagger(personal.labelled_table(spark))
    return personal.find_personal(read(spark, sf_dir, "documents"), tagger).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base", 256).alias("base_sha256"), "spans",
    )


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.choose(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32",
        "sequence_id", "offset",
    )


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    scorer = toxicity.fit_scorer(docs, labels.where(~held_out))
    return toxicity.score(docs, scorer).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(read(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _page(column: str):
    return F.regexp_extract(column, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.page_records(read(spark, sf_dir, "pages")), path)
    stored = warc.read(spark, path).where("record_type = 'response'")
    again = warc.read(spark, path, payload=False).where("record_type = 'revisit'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        stored.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
        .withColumn("payload_digest", F.sha2("payload", 256))
        .unionByName(
            again.withColumn("payload_bytes", F.col("payload_length")).withColumn(
                "payload_digest", F.substring_index("payload_digest", ":", -1)
            )
        )
        .withColumn("page_id", _page("record_id"))
        .withColumn("refers_to", _page("refers_to"))
        .select(*columns)
    )


ORACLE["op10_warc"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages),
q AS (
    SELECT *, payload_bytes >= 100 AND first IS NOT NULL
              AND page_id IS DISTINCT FROM first AS again
    FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM q
"""


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read(spark, sf_dir, "pages"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
           max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels GROUP BY doc_id),
m AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t)
                  THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
    FROM w),
counted AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS n_good,
           sum(coalesce(bad, 0)) AS n_bad
    FROM m LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
          AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
    SELECT filter_order, step, bits[step] AS own,
           coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier
    FROM orders, range(1, 6) AS r(step)),
found AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN mask & (earlier + own) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & earlier > 0 AND mask & own > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN n_good ELSE 0 END)
               AS good_lost,
           sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN n_bad ELSE 0 END)
               AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept,
       removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM found
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


# crc32 goes bit by bit: -1 in the list stands for one shift.
ORACLE["op13_prefix_trie"] = """
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1
               AS place
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT c, (4294967295 - list_reduce(
               [4294967295::BIGINT] || flatten([
                   [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                   FOR x IN string_split(c::VARCHAR, '')]),
               lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                           ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 6 AS h
    FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
    SELECT v.c, 0 AS own, place, role, text
    FROM convs v JOIN turns t ON t.c = v.c - v.c % 100 AND place < h
    UNION ALL
    SELECT v.c, 1, place, role, text FROM convs v JOIN turns t ON t.c = v.c AND place >= h),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY own, place) AS d FROM rebuilt),
ways AS (
    SELECT c, d, length(text) AS chars, sha256(string_agg(sha256(role) || sha256(text), '')
               OVER (PARTITION BY c ORDER BY d)) AS node
    FROM numbered
    UNION ALL
    SELECT c, 0, 0, '' FROM convs),
linked AS (
    SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS last
    FROM ways WINDOW w AS (PARTITION BY c ORDER BY d)),
nodes AS (
    SELECT node, min(c) AS c, max(d) AS d, max(parent) AS parent, count(*) AS n_convs,
           max(chars) AS chars, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last) AS ids
    FROM linked GROUP BY node),
children AS (
    SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children
    FROM nodes LEFT JOIN children USING (node)),
sums AS (
    SELECT w.node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           sum((n_convs - 1) * o.chars) AS saved_tokens
    FROM own o JOIN ways w ON w.c = o.c AND w.d <= o.d GROUP BY w.node)
SELECT o.c AS conv_id, o.d AS depth, p.c AS parent_conv_id, o.n_convs, o.n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(o.ids, '')) AS ends_sha256
FROM own o JOIN sums USING (node) LEFT JOIN nodes p ON p.node = o.parent
"""
