"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from farelake.llm import (
    chat,
    decontamination,
    filter_audit,
    fingerprints,
    lexical_search,
    licences,
    near_duplicates,
    quality,
    sharding,
    suffix_dedup,
    tables,
    token_counts,
    tree_bpe,
    warc,
)

VOCABULARY = "byte_bpe_50k.json"


def op1_bpe(spark, sf):
    docs = tables.read(spark, sf, "documents", "doc_id", "text")
    return tree_bpe.encoded_digests(docs, public_tokenizers.path(VOCABULARY))


def op2_decontamination(spark, sf):
    docs = tables.read(spark, sf, "documents", "doc_id", "text")
    return decontamination.leaks(docs, tables.read(spark, sf, "benchmark", "item_id", "text"))


def op3_chat(spark, sf):
    said = tables.read(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], said.schema)
    return chat.format_conversations(said.unionByName(extra))


def op4_suffix_dedup(spark, sf):
    return suffix_dedup.dedup(tables.read(spark, sf, "documents", "doc_id", "text"), ["doc_id"])


def op5_licences(spark, sf):
    return licences.scan(tables.read(spark, sf, "documents", "doc_id", "text"))


def op6_warc(spark, sf):
    path = f"{tables.shared_dir(spark)}/warc-{tables.uuid.uuid4().hex}"
    warc.write_archives(tables.read(spark, sf, "pages", "page_id", "url", "html"), path)
    return warc.read_archives(spark, path)


def op7_token_counts(spark, sf):
    docs = tables.read(spark, sf, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path(VOCABULARY))


def op8_fingerprints(spark, sf):
    return fingerprints.compare_neighbours(tables.read(spark, sf, "documents", "doc_id", "text"))


def op9_near_duplicates(spark, sf):
    docs = tables.read(spark, sf, "documents", "doc_id", "text")
    return near_duplicates.classes(docs).select("doc_id", "class_id")


def op10_quality(spark, sf):
    docs = tables.read(spark, sf, "documents", "doc_id", "text")
    return quality.score(docs, quality.train(docs, tables.read(spark, sf, "labels", "doc_id", "quality")))


SHARDS = 24


def op11_sharding(spark, sf):
    placed = sharding.assign(tables.read(spark, sf, "documents", "doc_id", "text"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op12_lexical_search(spark, sf):
    docs = tables.read(spark, sf, "documents", "doc_id", "text")
    return lexical_search.search(docs, tables.read(spark, sf, "benchmark", "item_id", "text"))


def op13_filter_audit(spark, sf):
    labels = tables.read(spark, sf, "labels", "doc_id", "quality", "toxic")
    docs = filter_audit.read_documents(spark, f"{sf}/documents.parquet").select("doc_id", "text", "source")
    return filter_audit.audit(docs, labels, f"{tables.shared_dir(spark)}/audit-{tables.uuid.uuid4().hex}")


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_decontamination,
        op3_chat,
        op4_suffix_dedup,
        op5_licences,
        op6_warc,
        op7_token_counts,
        op8_fingerprints,
        op9_near_duplicates,
        op10_quality,
        op11_sharding,
        op12_lexical_search,
        op13_filter_audit,
    )
}

_CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(t) + length(t) - length(replace(t, '\', ''))
      + length(t) - length(regexp_replace(t, '#{3,}', '', 'g'))
      + (length(t) - length(replace(t, '</turn>', ''))) // 7 AS text_chars,
    CASE WHEN role IN ('user', 'assistant', 'system') THEN length(role)
      ELSE 1 + length(role) + length(role) - length(replace(role, '\', ''))
        + length(role) - length(regexp_replace(role, '#{3,}', '', 'g'))
        + (length(role) - length(replace(role, '</turn>', ''))) // 7 + length(role) - length(replace(role, ':', ''))
      END AS role_chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN t ELSE '' END, '' ORDER BY turn NULLS FIRST, role, t)) AS loss_sha256,
  CAST(sum(4 + role_chars + 2 + text_chars + 9) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_PASSAGES = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
    hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT r, k, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT r, k, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM d)
), leasts AS (SELECT s, min(k) AS least FROM strings GROUP BY s
), starts AS (
  SELECT r, p, p > lag(p) OVER (PARTITION BY r ORDER BY p) + 50 AS apart
  FROM strings JOIN leasts USING (s) WHERE k > least
), runs AS (
  SELECT r, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT r, p, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS n FROM starts)
  GROUP BY r, n
), cuts AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS after FROM runs
), kept AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS head
  FROM cuts JOIN d USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages
), latest AS (SELECT payload, max(page_id) AS latest FROM p WHERE n >= 1000 GROUP BY payload),
paired AS (
  SELECT *, CASE WHEN latest IS NOT NULL AND (page_id IS NULL OR page_id < latest) THEN latest END AS refers_to
  FROM p LEFT JOIN latest USING (payload)
)
SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM paired
"""

_CLASSES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT w, min(doc_id) AS least, row_number() OVER () AS node FROM d GROUP BY w
), grams AS (
  SELECT node, array_to_string(w[i : i + 4], ' ') AS g, count(*) AS c
  FROM (SELECT node, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END)) AS i FROM t)
  GROUP BY node, g
), sizes AS (SELECT node, sum(c) AS n FROM grams GROUP BY node
), shared AS (
  SELECT x.node AS a, y.node AS b, sum(least(x.c, y.c)) AS m FROM grams x JOIN grams y ON x.g = y.g AND x.node < y.node
  GROUP BY x.node, y.node
), links AS (
  SELECT a, b FROM shared JOIN sizes u ON u.node = a JOIN sizes v ON v.node = b
  WHERE CAST(m AS DOUBLE) / CAST(u.n + v.n - m AS DOUBLE) >= CAST(0.8 AS DOUBLE)
), paired AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT node, node AS other FROM t
  UNION SELECT reach.node, paired.b FROM reach JOIN paired ON reach.other = paired.a
), classes AS (SELECT reach.node, min(t.least) AS class_id FROM reach JOIN t ON t.node = reach.other GROUP BY reach.node)
SELECT doc_id, class_id FROM d JOIN t USING (w) JOIN classes USING (node)
"""

_SHARDS = """
WITH crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS steps
  FROM range(256) t(i)
), d AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
    CAST(xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda x: CAST('0x' || x AS BIGINT)),
      lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]))) AS BIGINT) AS text_crc32
  FROM documents, crc
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS LAST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) AS nth, sum(size) OVER () AS total
  FROM d
), dealt AS (SELECT *, CAST((2 * upto - size) * 24 // (2 * total) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  nth - min(nth) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""

_RANKED = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), q AS (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), asked AS (SELECT i, item_id, term, count(*) AS times FROM q GROUP BY ALL
), size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d WHERE len(w) > 0
), bags AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM bags, size GROUP BY term, n_docs
), lengths AS (
  SELECT r, doc_id, 75 + CAST((25 * len(w) * n_docs) // n_words AS BIGINT) AS m FROM d, size
), scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN bags USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

_AUDIT = r"""
WITH marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), d AS (
  SELECT coalesce(source, '') AS part, coalesce(text, '') AS t, coalesce(doc_id, 9223372036854775807) AS id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM documents LEFT JOIN marked USING (doc_id)
), masks AS (
  SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
    WHEN 'A' THEN len(w) < 50 WHEN 'B' THEN 100 * len(list_distinct(w)) < 65 * len(w)
    WHEN 'C' THEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t)
    WHEN 'D' THEN regexp_matches(t, '[#$%&*|]') ELSE id > least END) AS fails
  FROM (SELECT *, min(id) OVER (PARTITION BY t) AS least FROM d)
), counts AS (SELECT part, good, toxic, fails, count(*) AS n FROM masks GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), tested AS (
  SELECT part, array_to_string(o, '') AS filter_order, CAST(step AS INTEGER) AS step, o[step] AS f, n, good, toxic, fails,
    list_contains(fails, o[step]) AS here, list_has_any(fails, o[1:step - 1]) AS gone
  FROM counts, steps
), sums AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (NOT here AND NOT gone) AS kept, sum(n) FILTER (here AND NOT gone) AS removed,
    sum(n) FILTER (here AND gone) AS redundant, sum(n) FILTER (fails = [f]) AS unique_fails,
    sum(n) FILTER (here AND NOT gone AND good = 1) AS good_lost, sum(n) FILTER (here AND NOT gone AND toxic = 1) AS toxic_lost
  FROM tested GROUP BY ALL
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM sums
"""

SQL = {
    "op3_chat": _CHAT,
    "op4_suffix_dedup": _PASSAGES,
    "op6_warc": _ARCHIVES,
    "op9_near_duplicates": _CLASSES,
    "op11_sharding": _SHARDS,
    "op12_lexical_search": _RANKED,
    "op13_filter_audit": _AUDIT,
}
