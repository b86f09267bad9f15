"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import remainder, table
from tidemark.llm.decontaminate import leaks
from tidemark.llm.divergence import divergences
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.jaccard_join import similar_sets
from tidemark.llm.language import identify, learn
from tidemark.llm.line_dedup import drop_lines
from tidemark.llm import secrets
from tidemark.llm.pieces import decode, encode_parts, joined
from tidemark.llm.tokens import token_counts
from tidemark.llm.tool_calls import calls_of_chats, link_calls
from tidemark.llm.toxicity import toxicity
from tidemark.llm.vector_codes import compress
from tidemark.llm.warc import round_trip

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES["op2_exact_dedup"] = op2_exact_dedup
SQL["op2_exact_dedup"] = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op9_decontaminate"] = op9_decontaminate
SQL["op9_decontaminate"] = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS tokens FROM documents),
     i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS tokens FROM benchmark),
     parts AS (SELECT DISTINCT item_id, width, array_to_string(tokens[k:k + width - 1], ' ') AS shingle
               FROM (SELECT item_id, tokens, width, unnest(range(1, len(tokens) - width + 2)) AS k
                     FROM (SELECT *, least(5, len(tokens)) AS width FROM i WHERE len(tokens) > 0))),
     runs AS (SELECT DISTINCT doc_id, width, array_to_string(tokens[k:k + width - 1], ' ') AS shingle
              FROM (SELECT doc_id, tokens, width, unnest(range(1, len(tokens) - width + 2)) AS k
                    FROM d, (SELECT DISTINCT width FROM parts) WHERE len(tokens) >= width)),
     sizes AS (SELECT item_id, count(*) AS n_item FROM parts GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM runs JOIN parts USING (width, shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), revisit_from=0)


QUERIES["op3_warc"] = op3_warc
SQL["op3_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), width=4, percent=85)


QUERIES["op8_jaccard_join"] = op8_jaccard_join
SQL["op8_jaccard_join"] = r"""
WITH RECURSIVE split AS (
       SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
     shingles AS (SELECT DISTINCT doc_id, array_to_string(words[k:k + n - 1], ' ') AS shingle
                  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS k
                        FROM (SELECT *, least(4, len(words)) AS n FROM split WHERE len(words) > 0))),
     sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
     links AS (SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b USING (shingle)
                                 WHERE a.doc_id <> b.doc_id GROUP BY ALL)
               JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
     reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reached USING (doc_id) GROUP BY d.doc_id
"""


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)
    model = learn(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), model)


QUERIES["op10_language"] = op10_language


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 3) == 1
    return toxicity(docs, labels, ~held_out).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES["op1_toxicity"] = op1_toxicity


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs.select("doc_id", "text"), secrets.learn(docs))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind != "random")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))


QUERIES["op4_secrets"] = op4_secrets


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES["op5_token_counts"] = op5_token_counts


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    short, long = map(decode, encode_parts(table(spark, sf_dir, "documents")))
    same = (F.col("decoded") == F.col("source")).alias("round_trip")
    short = short.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_chunks", F.xxhash64("chunk", "ids").alias("ids_hash"), same)
    return short.unionByName(joined(long).drop("row"))


QUERIES["op6_sentencepiece"] = op6_sentencepiece


# The tools that op7 calls: a reply needs a text, an instruction its length as well and nothing else.
CHAT_TOOLS = [("reply", "text", "string", True), ("reply", "turn", "integer", True), ("reply", "length", "integer", False),
              ("instruct", "text", "string", True), ("instruct", "length", "number", True)]


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = calls_of_chats(table(spark, sf_dir, "conversations"))
    tools = spark.createDataFrame(CHAT_TOOLS, "name string, field string, type string, required boolean")
    linked = link_calls(calls, results, tools)
    return linked.withColumn("errors", F.array_join("errors", ","))


QUERIES["op7_tool_calls"] = op7_tool_calls
SQL["op7_tool_calls"] = r"""
WITH RECURSIVE said AS (SELECT conv_id, turn, role, text, 'call-' || turn AS call_id FROM conversations),
     calls AS (SELECT s.conv_id, s.turn, s.call_id, s.text, CASE s.role WHEN 'user' THEN 'reply' ELSE 'instruct' END AS name,
                      CASE WHEN s.role = 'user' AND b.turn IS NOT NULL THEN b.call_id END AS after
               FROM said s LEFT JOIN (SELECT DISTINCT conv_id, turn, call_id FROM said WHERE role = 'user') b ON b.conv_id = s.conv_id AND b.turn = s.turn - 2
               WHERE s.role IN ('user', 'system')),
     results AS (SELECT conv_id, turn, 'call-' || (turn - 1) AS call_id, text AS content FROM said WHERE role = 'assistant'),
     depth AS (SELECT conv_id, call_id, 0::BIGINT AS level FROM calls WHERE after IS NULL
               UNION ALL SELECT c.conv_id, c.call_id, d.level + 1 FROM calls c JOIN depth d ON d.conv_id = c.conv_id AND d.call_id = c.after),
     linked AS (SELECT c.*, d.level, r.content,
                       list_sort(list_concat(CASE WHEN c.text IS NULL THEN ['missing:text'] ELSE [] END,
                                             CASE WHEN name = 'instruct' THEN ['unexpected:turn'] ELSE [] END,
                                             CASE WHEN name = 'instruct' AND c.text IS NULL THEN ['missing:length'] ELSE [] END)) AS errors
                FROM calls c JOIN depth d USING (conv_id, call_id) LEFT JOIN results r USING (conv_id, call_id)),
     judged AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'invalid' WHEN content IS NULL THEN 'no_result' ELSE 'ok' END AS status FROM linked)
SELECT conv_id, level, turn, call_id, name, status, array_to_string(errors, ',') AS errors,
       '{"arguments":{' || coalesce('"length":' || length(text) || ',"text":' || to_json(text) || ',', '') || '"turn":' || turn
       || '},"call_id":"' || call_id || '"' || CASE WHEN len(errors) > 0 THEN ',"errors":' || to_json(errors) ELSE '' END
       || ',"level":' || level || ',"name":"' || name || '"' || coalesce(',"result":' || to_json(content), '')
       || ',"status":"' || status || '","turn":' || turn || '}' AS json
FROM judged
UNION ALL
SELECT conv_id, NULL, turn, call_id, NULL, 'orphan_result', '',
       '{"call_id":"' || call_id || '"' || coalesce(',"result":' || to_json(content), '') || ',"status":"orphan_result","turn":' || turn || '}'
FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
"""


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


QUERIES["op11_source_divergence"] = op11_source_divergence
SQL["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
     t AS (SELECT r, lang, source, unnest(words) AS term FROM d),
     kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
     n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
     groups AS (SELECT DISTINCT lang, source FROM d),
     dense AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
     p AS (SELECT *, 1 + (1000000000 * (n + 1)) // (sum(n) OVER w + count(*) OVER w)::BIGINT AS p FROM dense WINDOW w AS (PARTITION BY lang, source)),
     whole AS (SELECT lang, term, sum(n)::BIGINT AS n FROM dense GROUP BY ALL),
     q AS (SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER w + count(*) OVER w)::BIGINT AS q FROM whole WINDOW w AS (PARTITION BY lang)),
     sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
               FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
               UNION ALL
               SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES["op12_line_dedup"] = op12_line_dedup
SQL["op12_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM d),
     keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     repeated AS (SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
     judged AS (SELECT *, coalesce(doc_id <> keep_id, false) AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


QUERIES["op13_vector_codes"] = op13_vector_codes
_NEAREST = """(SELECT vec_id, position, number, distance FROM (
    SELECT v.vec_id, v.position, b.number, list_sum(list_transform(range(1, 5), lambda i: (v.part[i] - b.part[i]) * (v.part[i] - b.part[i])))::BIGINT AS distance
    FROM parts v JOIN {book} b USING (position)) QUALIFY row_number() OVER (PARTITION BY vec_id, position ORDER BY distance, number) = 1)"""
_REFINED = """(SELECT b.position, b.number, coalesce(m.part, b.part) AS part FROM {book} b LEFT JOIN (
    SELECT position, number, list_transform(range(1, 5), lambda i: floor(sums[i]::DOUBLE / n)::BIGINT) AS part FROM (
        SELECT a.position, a.number, count(*) AS n, [sum(part[1])::BIGINT, sum(part[2])::BIGINT, sum(part[3])::BIGINT, sum(part[4])::BIGINT] AS sums
        FROM {found} a JOIN parts USING (vec_id, position) GROUP BY ALL)) m USING (position, number))"""
SQL["op13_vector_codes"] = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS whole FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     parts AS MATERIALIZED (SELECT vec_id, k AS position, whole[4 * k + 1:4 * k + 4] AS part FROM kept, range(16) t(k)),
     book0 AS MATERIALIZED (SELECT position, rank() OVER (PARTITION BY position ORDER BY vec_id) - 1 AS number, part
                            FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
     found1 AS MATERIALIZED {_NEAREST.format(book="book0")},
     book1 AS MATERIALIZED {_REFINED.format(book="book0", found="found1")},
     found2 AS MATERIALIZED {_NEAREST.format(book="book1")},
     book2 AS MATERIALIZED {_REFINED.format(book="book1", found="found2")},
     codes AS (SELECT vec_id, string_agg(printf('%02x', number), '' ORDER BY position) AS code, sum(distance)::BIGINT AS error
               FROM {_NEAREST.format(book="book2")} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY position, number)) FROM book2) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id)
"""
