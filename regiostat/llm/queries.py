"""One query for each operator over its whole table, and their DuckDB twins.

Where SQL cannot state an operator (trained models, hash-random orders,
packing, structural parsing), tests/llm holds the query against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import bpe, conversation, lang_id, lexical, lm_score, mixing, near_dup, packing, quality, secret_scan
from . import substring, topk, warc
from .common import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(mixing.sized(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.filter_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "distance", "kept")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.report(secret_scan.find_secrets(docs))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lm_score.is_held_out(F.col("doc_id"), 3, 1)
    model = lang_id.fit(docs, ~held_out)
    out = lang_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair(conversation.damaged(table(spark, sf_dir, "conversations")))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash_dedup, op2_best_fit_packing, op3_warc, op4_source_mix, op5_lm_score,
                            op6_quality_rules, op7_secret_scan, op8_exact_topk, op9_substring_dedup, op10_language_id,
                            op11_conversation_repair, op12_bpe_round_trip, op13_lexical_search)}
QUERIES["pipeline"] = corpus_pipeline.run

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_minhash_dedup": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"coalesce({_LOWER}, '')")} AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
                  WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                  ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
                  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
                  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION
                                 SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
        least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least.component_id,
               d.doc_id = least.component_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op3_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
        q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to FROM q""",
    "op8_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
        s AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
        g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM s),
        m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
        gone AS (SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + 13)) AS i FROM g JOIN m ON g.g = m.g WHERE g.doc_id > m.first),
        each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
        left_over AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS kept, count(*) AS n
                 FROM each e ANTI JOIN gone USING (doc_id, i) GROUP BY e.doc_id)
        SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, (len(w.ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
               sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN left_over k USING (doc_id)""",
}
# crc32 byte by byte; edits of one row, then up to two inserted rows, and of each state's ways the least (cost, audit)
ORACLE["op11_conversation_repair"] = """
    WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    c AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role,
                 coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    h AS (SELECT c.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
                                      lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) % 20 AS f FROM c, crc),
    d AS (SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE f <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                 trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS r FROM d),
    s AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
                 lag(r) OVER (PARTITION BY c ORDER BY i) || r AS two FROM o),
    e AS (SELECT *, bare = '' AS is_blank, bare <> '' AND again AS is_again,
                 bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS is_cut FROM s),
    n AS (SELECT c, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate,
                 count(*) FILTER (is_cut) AS truncated,
                 count(*) FILTER (two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY c),
    -- states: 0 nothing yet, 1 after s, 2 after u, 3 after a
    edit(q, r, p, letter, cost, name) AS (VALUES
        (0, 's', 1, 'K', 0, NULL), (0, 'u', 2, 'K', 0, NULL), (1, 'u', 2, 'K', 0, NULL), (3, 'u', 2, 'K', 0, NULL),
        (2, 'a', 3, 'K', 0, NULL), (0, NULL, 0, 'D', 2, NULL), (1, NULL, 1, 'D', 2, NULL), (2, NULL, 2, 'D', 2, NULL),
        (3, NULL, 3, 'D', 2, NULL), (0, NULL, 2, 'R', 1, 'user'), (1, NULL, 2, 'R', 1, 'user'), (3, NULL, 2, 'R', 1, 'user'),
        (2, NULL, 3, 'R', 1, 'assistant')),
    more(q, p, letters, cost, rows) AS (VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
        (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']),
        (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])),
    way(c, i, q, best) AS (
        SELECT n.c, 0::BIGINT, more.p, {'cost': more.cost::BIGINT, 'audit': more.letters, 'rows': more.rows}
        FROM n, more WHERE more.q = 0
        UNION ALL
        SELECT way.c, way.i + 1, more.p, min({
            'cost': way.best.cost + edit.cost + CASE WHEN e.is_cut AND edit.letter <> 'D' THEN 5 ELSE 0 END + more.cost,
            'audit': way.best.audit || edit.letter || more.letters,
            'rows': list_concat(list_concat(way.best.rows, CASE WHEN edit.letter = 'D' THEN []
                                ELSE [coalesce(edit.name, e.role) || ':' || e.text] END), more.rows)})
        FROM way JOIN e ON e.c = way.c AND e.i = way.i + 1
        JOIN edit ON edit.q = way.q AND (edit.r IS NULL OR edit.r = e.r) AND (edit.letter = 'D' OR NOT (e.is_blank OR e.is_again))
        JOIN more ON more.q = edit.p GROUP BY way.c, way.i, more.p),
    last AS (SELECT way.c, min(best) AS best FROM way JOIN n ON n.c = way.c AND n.n = way.i WHERE q IN (0, 3) GROUP BY way.c)
    SELECT x.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
           sha256(coalesce(array_to_string(best.rows, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT c, conv_id FROM c) x LEFT JOIN n ON n.c = x.c LEFT JOIN last ON last.c = x.c"""
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_lexical_search"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(_LOWER)} AS w FROM documents),
    p AS (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d),
    tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, t, count(*) AS tf FROM p GROUP BY r, t),
    s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS len FROM d),
    q AS (SELECT DISTINCT item_id, text, unnest({_TERMS.format(_LOWER)}) AS t FROM benchmark),
    w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t),
    x AS (SELECT q.item_id, q.text, tf.r, any_value(tf.doc_id) AS doc_id,
                 sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * tf.n * s.docs) // s.len))))::BIGINT AS score
          FROM q JOIN tf ON tf.t = q.t JOIN w ON w.t = q.t, s GROUP BY q.item_id, q.text, tf.r),
    o AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
          FROM x WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10"""
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
