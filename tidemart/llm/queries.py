"""The operators bound to the generated tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import conversation_trie, decontamination, language_id, language_model, line_dedup, mixing, quality, sharding, simhash, token_counts, url_filter, warc, whitening
from tidemart.llm.text import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# fixed rules of the query: action, host, path
URL_RULES = """
SELECT * FROM VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
AS rules(action, host, path)
"""


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return language_model.score_documents(docs, language_model.fifth_held_out())


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, spark.sql(URL_RULES)).drop("url")


OP2_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(action, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN fits USING (host, path)
"""


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = mixing.with_size(table(spark, folder, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mixing.assign(stored(docs, "sizes"))
    digest = mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("position"))
    return digest.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / (2.0::DOUBLE ^ 48) AS u
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][kind + 1]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS bound FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER earlier, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fixed AS (
  SELECT level FROM levels WHERE level * weight <= bound ORDER BY bound / weight, source NULLS LAST LIMIT 1
), planned AS (
  SELECT source, source_size, weight, kind, least(bound, coalesce((SELECT level FROM fixed) * weight, bound)) AS target
  FROM weighed
), ordered AS (
  SELECT s.*, p.source_size, p.weight, p.kind, p.target,
         coalesce(sum(size) OVER (PARTITION BY p.source, p.source_size, p.kind ORDER BY u, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
), copied AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END AS rounds FROM ordered
), counted AS (
  SELECT *, (rounds + CASE WHEN before + size / 2::DOUBLE < target - rounds * source_size::DOUBLE AND rounds < 3
                           THEN 1 ELSE 0 END)::INT AS copies,
         before / target * weight AS demand
  FROM copied
), placed AS (
  SELECT *, CASE WHEN kind = 0 THEN 0.0 WHEN kind = 1 THEN 0.0 WHEN demand >= 0.375 THEN 0.5 ELSE 0.0 END::DOUBLE AS t,
         CASE WHEN kind = 0 THEN 7.5 WHEN kind = 1 THEN 2.0 WHEN demand >= 0.375 THEN 1.0 ELSE 0.5 END::DOUBLE AS a,
         CASE WHEN kind = 0 THEN -5.0 WHEN kind = 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS slope,
         demand - CASE WHEN kind = 2 AND demand >= 0.375 THEN 0.375 ELSE 0.0 END::DOUBLE AS rest
  FROM counted
)
SELECT doc_id, size, source_size, target, copies * size AS taken,
       CASE WHEN copies > 0 AND target > 0 THEN t + 2 * rest / (a + sqrt(a * a + 2 * slope * rest)) END AS position
FROM placed
"""


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    signals = stored(quality.with_signals(docs).drop("text"), "signals")
    return quality.judge(signals).select("doc_id", *quality.COUNTS, "base_failed", "kept", "reasons")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find_passages(docs, table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


# windows as whole words between separators, so that containment is that of word sequences
OP3_SQL = r"""
WITH RECURSIVE item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win, least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), doc_windows AS (
  SELECT row_id, i, list_slice(w, i, i + size - 1) AS win, size
  FROM (SELECT row_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT row_id, i, h.size, item_id FROM doc_windows h JOIN windows USING (win)
), items AS (
  SELECT row_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM (SELECT DISTINCT row_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id
), covered AS (
  SELECT row_id, count(DISTINCT k) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT row_id, i, size FROM hits)) GROUP BY row_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN covered USING (row_id) LEFT JOIN items USING (row_id)
"""


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", *sharding.DIMENSIONS)
    return sharding.shard_documents(docs, 40)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages, archives = table(spark, folder, "pages").select("page_id", "url", "html"), warc.archive_folder(spark)
    directory = warc.write_archives(pages, archives)
    read = warc.look_up(directory, archives, pages, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     copies AS (SELECT body, max(page_id) AS first_id FROM p WHERE strlen(body) >= 1000 GROUP BY body)
SELECT page_id, strlen(p.body) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN copies ON p.body = copies.body
"""


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return token_counts.with_limit(counted, 2048).select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", "over_limit")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.drop_frequent_lines(docs)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
  SELECT row_id, doc_id, n, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_id, doc_id, unnest(l) AS line, unnest(range(len(l))) AS n
        FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f ON lines.key = f.key GROUP BY row_id, doc_id
"""


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    prints = stored(simhash.with_fingerprints(docs, name="_s_print").drop("text"), "prints")
    found = simhash.joined_components(prints, simhash.component_map(prints))
    return found.select("doc_id", "fingerprint", "component_id")


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", language_id.quarter_held_out())
    model = language_id.fit(docs, ~F.col("held_out"))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.turns_in_order(table(spark, folder, "conversations"))
    rebuilt = stored(conversation_trie.share_openings(turns), "rebuilt")
    return conversation_trie.prefix_trie(rebuilt, turns.select("conv").distinct())


# CRC-32 bit by bit; prefixes as lists of digests, each node's totals over the nodes below by a join
OP12_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS pos, d, w
  FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS w
        FROM conversations WHERE conv_id IS NOT NULL)
), crc(conv, rest, c, bit) AS (
  SELECT DISTINCT conv, conv::VARCHAR, 4294967295::BIGINT, 8 FROM turns
  UNION ALL
  SELECT conv, CASE WHEN bit = 8 THEN substr(rest, 2) ELSE rest END,
         CASE WHEN bit = 8 THEN xor(c, ascii(rest)::BIGINT)
              WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END,
         CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END
  FROM crc WHERE NOT (bit = 8 AND rest = '')
), heads AS (
  SELECT conv, conv - conv % 20 AS base, xor(c, 4294967295::BIGINT) % 4 AS h FROM crc WHERE bit = 8 AND rest = ''
), rebuilt AS (
  SELECT h.conv, t.pos, t.d, t.w FROM heads h JOIN turns t ON t.conv = h.base AND t.pos < h.h
  UNION ALL
  SELECT h.conv, 1000 + t.pos, t.d, t.w FROM heads h JOIN turns t ON t.conv = h.conv AND t.pos >= h.h
), paths AS (
  SELECT conv, row_number() OVER p AS depth, string_agg(d, '') OVER p AS path, w FROM rebuilt
  WINDOW p AS (PARTITION BY conv ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL
  SELECT conv, 0, '', 0 FROM heads
), nodes AS (
  SELECT path, depth, min(conv) AS conv, count(*) AS n, any_value(w) AS w FROM paths GROUP BY path, depth
), last AS (
  SELECT conv, max(depth) AS depth FROM paths GROUP BY conv
), ends AS (
  SELECT path, sha256(string_agg(conv::VARCHAR, ',' ORDER BY conv)) AS sha FROM paths JOIN last USING (conv, depth) GROUP BY path
), arcs AS (
  SELECT c.path, p.conv AS parent, p.path AS parent_path FROM nodes c JOIN nodes p
  ON p.depth = c.depth - 1 AND p.path = substr(c.path, 1, 32 * p.depth)
), children AS (
  SELECT parent_path AS path, count(*) AS n_children FROM arcs GROUP BY parent_path
), below AS (
  SELECT a.path, sum((v.n - 1) * v.w) AS saved, count(*) FILTER (k.n_children IS NULL) AS leaves
  FROM nodes v JOIN paths a ON a.conv = v.conv AND a.depth <= v.depth LEFT JOIN children k ON k.path = v.path
  GROUP BY a.path
)
SELECT conv AS conv_id, depth, parent AS parent_conv_id, n AS n_convs, coalesce(n_children, 0) AS n_children,
       leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes LEFT JOIN arcs USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path) JOIN below USING (path)
"""


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    steps = stored(whitening.with_steps(table(spark, folder, "embeddings")).select("vec_id", "x"), "steps")
    return whitening.whiten(steps, whitening.fit(steps))


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_lm_scoring": (op1_lm_scoring, None),
    "op2_url_filter": (op2_url_filter, OP2_SQL),
    "op3_decontamination": (op3_decontamination, OP3_SQL),
    "op4_sharding": (op4_sharding, None),
    "op5_warc": (op5_warc, OP5_SQL),
    "op6_token_counts": (op6_token_counts, None),
    "op7_line_dedup": (op7_line_dedup, OP7_SQL),
    "op8_mixing": (op8_mixing, OP8_SQL),
    "op9_quality": (op9_quality, None),
    "op10_simhash": (op10_simhash, None),
    "op11_language_id": (op11_language_id, None),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_whitening": (op13_whitening, None),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
