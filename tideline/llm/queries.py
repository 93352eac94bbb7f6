"""The operators applied to their whole tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    conversations,
    decontamination,
    exact,
    extraction,
    infilling,
    jaccard,
    language,
    lines,
    maxent,
    mixing,
    quality,
    reputation,
    substrings,
)
from tideline.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language.page_languages(table(spark, folder, "pages"))
    return found.select("page_id", "lang", "declared", "posterior", "accepted")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, folder, "documents"), with_text=False)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d)
), f AS (SELECT run, min(doc_id) AS first FROM w GROUP BY run
), s AS (SELECT doc_id, i FROM w JOIN f USING (run) WHERE first < doc_id
), p AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM s
), k AS (
  SELECT v.doc_id, v.i, v.word, p.i IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d) v
  LEFT JOIN p ON p.doc_id = v.doc_id AND p.i = v.i
), g AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM k GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.dedup_lines(table(spark, folder, "documents"), with_text=False)


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key
), j AS (SELECT k.*, length(k.key) >= 10 AND first < doc_id AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    outcomes = reputation.labelled_pages(pages, table(spark, folder, "labels"))
    return reputation.filter_urls(pages, outcomes).drop("rate")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, folder, "documents"))
    return groups.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare
  FROM documents
), n AS (
  SELECT doc_id, sha256(bare) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n
"""


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    counts = mixing.mix_counts(table(spark, folder, "documents"))
    return counts.withColumnRenamed("id", "doc_id").drop("copies")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("items")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS size, array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)
), z AS (SELECT DISTINCT size FROM w
), o AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS run
  FROM (SELECT d.*, size, unnest(range(1, len(words) - size + 2)) AS i FROM d JOIN z ON size <= len(words))
), m AS (SELECT doc_id, item_id, i, o.size FROM o JOIN w ON w.run = o.run AND w.size = o.size
), h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score_documents(table(spark, folder, "documents"))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract_main_text(table(spark, folder, "pages"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents")).drop("class_id")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^ 	-
]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + least(4, len(words)) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - least(4, len(words)) + 2)) AS i FROM d WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS joint FROM s x JOIN s y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * joint >= 85 * (x.n + y.n - joint)
), r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id
FROM d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return conversations.repaired_summary(rows, conversations.damaged(rows))


#: Checksums by a table of the 256 bytes; states 0 to 3 of the grammar: nothing yet, after s, after u, after a.
OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]))) % 20 AS draw
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM c, (SELECT unnest([0, 1]) AS copy) WHERE draw <> 0 AND (copy = 0 OR draw = 3)
), n AS (
  SELECT *, row_number() OVER o AS i, left(role, 1) AS sym, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended,
         lag(left(role, 1)) OVER o AS prior
  FROM d WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))
), f AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM n
), moves(p, q, sym, cost, audit, lead) AS (
  VALUES (0, 1, 's', 0, 'K', ''), (0, 2, 'u', 0, 'K', ''), (0, 3, 'a', 3, 'IK', 'user:'), (1, 2, 'u', 0, 'K', ''), (1, 3, 'a', 3, 'IK', 'user:'),
         (2, 3, 'a', 0, 'K', ''), (2, 2, 'u', 3, 'IK', 'assistant:'), (3, 2, 'u', 0, 'K', ''), (3, 3, 'a', 3, 'IK', 'user:')
), acts AS (
  SELECT p, q, sym, cost, audit, lead, '' AS given FROM moves
  UNION ALL SELECT p, q, NULL, cost + 3, replace(audit, 'K', 'R'), lead, CASE sym WHEN 'u' THEN 'user' ELSE 'assistant' END FROM moves WHERE sym <> 's'
  UNION ALL SELECT s, s, NULL, 4, 'D', NULL, NULL FROM (SELECT unnest(range(4)) AS s)
), r AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best
  FROM (SELECT DISTINCT conv_id FROM f)
  UNION ALL
  SELECT conv_id, i, state, min(best) FROM (
    SELECT r.conv_id, f.i, a.q AS state, {
      'cost': r.best.cost + a.cost + CASE WHEN f.fault = 'truncated' AND a.given IS NOT NULL THEN 3 ELSE 0 END, 'audit': r.best.audit || a.audit,
      'lines': CASE WHEN a.given IS NULL THEN r.best.lines
                    ELSE list_concat(r.best.lines, CASE WHEN a.lead = '' THEN CAST([] AS VARCHAR[]) ELSE [a.lead] END,
                                     [CASE WHEN a.given = '' THEN f.role ELSE a.given END || ':' || f.text]) END} AS best
    FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1
    JOIN acts a ON a.p = r.state AND (a.given IS NULL OR f.fault IS NULL OR f.fault = 'truncated') AND (a.sym IS NULL OR a.sym = f.sym)
  ) GROUP BY conv_id, i, state
), z AS (
  SELECT conv_id, min({'cost': best.cost + e.cost, 'audit': best.audit || e.audit,
         'lines': list_concat(best.lines, e.lines)}) AS best
  FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS n FROM r) r
  JOIN (VALUES (0, 0, '', CAST([] AS VARCHAR[])), (1, 6, 'II', ['user:', 'assistant:']), (2, 3, 'I', ['assistant:']), (3, 0, '', CAST([] AS VARCHAR[])))
       e(state, cost, audit, lines) ON e.state = r.state AND r.i = r.n
  GROUP BY conv_id
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE prior || sym NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id
)
SELECT o.conv_id, coalesce(g.gaps, 0) AS gaps, coalesce(g.blank, 0) AS blank, coalesce(g.duplicate, 0) AS duplicate,
       coalesce(g.truncated, 0) AS truncated, coalesce(g.illegal, 0) AS illegal, coalesce(z.best.cost, 0) AS cost,
       coalesce(z.best.audit, '') AS audit, sha256(coalesce(array_to_string(z.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    made = infilling.fill_in_middle(docs)
    return made.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), x AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(4), lambda k: CAST('0x' || substr(h, 1 + 8 * k, 8) AS BIGINT)) AS r FROM d
), c AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS lo, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
              WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x
), p AS (
  SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_substring_dedup,
        op3_line_dedup,
        op4_url_filter,
        op5_exact_dedup,
        op6_mix,
        op7_decontamination,
        op8_lm_score,
        op9_main_text,
        op10_jaccard_join,
        op11_conversation_repair,
        op12_fill_in_middle,
        op13_quality,
    )
}
ORACLES: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op4_url_filter": reputation.SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_mix": mixing.SQL,
    "op7_decontamination": OP7_SQL,
    "op10_jaccard_join": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
