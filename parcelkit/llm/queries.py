"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.llm import chat, editprints, licenses, lines, lm, mixing, packing, quality, ranking, simhash, topk, turns, urls
from parcelkit.llm.common import documents


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, found = F.col("licenses.base"), F.col("licenses.found")
    starts = F.transform(base, lambda s: s["start"].cast("long"))
    weights = F.transform(F.concat(base, found), lambda s: s["weight"])
    return licenses.scan(documents(spark, sf_dir)).select(
        "doc_id", F.col("licenses.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        licenses.labels(base).alias("base_labels"), licenses.labels(base, found).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"), found.alias("detections"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.col("filter")
    return urls.judge(documents(spark, sf_dir, "pages")).select(
        "page_id", *(f[c].alias(c) for c in ("host", "path", "rule", "verdict", "trust", "distrust")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    return quality.score(documents(spark, sf_dir)).select(
        "doc_id", *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                            "base_failed", "kept", "posterior", "votes")))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.group_documents(documents(spark, sf_dir), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and dropped (numbers of the lines that go, from 0)."""
    return lines.line_report(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "dropped")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return lm.score(documents(spark, sf_dir), held_out)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("mix")
    return mixing.place(documents(spark, sf_dir)).select(
        "doc_id", *(m[c].alias(c) for c in ("size", "source_size", "target")),
        (m["size"] * F.size(m["shards"])).cast("long").alias("taken"), m["shards"].alias("shards"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_conversations(rows))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), with_ids=False)


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprints.fingerprint_documents(documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), k=50)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.digests(turns.damage(documents(spark, sf_dir, "conversations")), "lost")


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_url_filter, op3_quality_rules, op4_simhash_near_dedup, op5_line_dedup, op6_lm_scoring,
    op7_mix_sources, op8_exact_top_k, op9_chat_formatting, op10_packing, op11_order_minhash,
    op12_ranked_search, op13_conversation_repair)}

# Escaped lengths in SQL: a backslash is doubled, and each control string has
# one inserted.
_ESCAPED = "regexp_replace(replace({0}, chr(92), chr(92) || chr(92)), '(" + "|".join(
    re.escape(c) for c in chat.CONTROL) + ")', chr(92) || chr(92) || '\\1', 'g')"

ORACLE: dict[str, str] = {
    "op8_exact_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
            FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
        t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 10""",
    "op9_chat_formatting": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
                   AS loss_sha256,
               sum({len(chat.OPEN + chat.MIDDLE + chat.CLOSE)} + length({_ESCAPED.format("role")})
                   + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents WHERE text IS NOT NULL),
        c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0),
        p AS (SELECT r, doc_id, t, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
              FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS t FROM d) GROUP BY r, doc_id, t),
        w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
              FROM p, c GROUP BY t, n_docs),
        q AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
              FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
        s AS (SELECT i, item_id, r, doc_id,
                     sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
              FROM q JOIN p USING (t) JOIN w USING (t), c GROUP BY i, item_id, r, doc_id)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
            FROM s WHERE score > 0) WHERE rank <= 50""",
    # The checksum byte by byte with its table; the cheapest audit state by
    # state of the grammar, row by row.
    "op13_conversation_repair": r"""
        WITH RECURSIVE tab AS (
            SELECT list_transform(range(256), lambda i: list_reduce(
                list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        c AS (SELECT row_number() OVER () AS k, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
        raw AS (
            SELECT c.k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(
                    string_split(coalesce(v.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                    lambda x: ascii(x)::BIGINT)),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS kind
            FROM conversations v JOIN c ON v.conv_id IS NOT DISTINCT FROM c.conv_id, tab),
        hurt AS (
            SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM raw WHERE kind <> 0),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS no,
                   rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
            FROM hurt),
        r AS (
            SELECT *, CASE WHEN body = '' THEN 'b'
                           WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY no) > 1 THEN 'd'
                           WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
                   left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY k ORDER BY no) AS before
            FROM numbered),
        f AS (
            SELECT k, 0::BIGINT AS no, {'c': 0::BIGINT, 'a': ''} AS s0, {'c': 1000000000::BIGINT, 'a': ''} AS s1,
                   {'c': 1000000000::BIGINT, 'a': ''} AS s2, {'c': 1000000000::BIGINT, 'a': ''} AS s3 FROM c
            UNION ALL
            SELECT k, no, {'c': s0.c + 4, 'a': s0.a || 'D'},
                   CASE WHEN use AND ini = 's' THEN list_min([{'c': s1.c + 4, 'a': s1.a || 'D'}, {'c': s0.c + late, 'a': s0.a || 'K'}])
                        ELSE {'c': s1.c + 4, 'a': s1.a || 'D'} END,
                   CASE WHEN use THEN list_min([{'c': i2.c + 4, 'a': i2.a || 'D'}, {'c': s0.c + u, 'a': s0.a || ul},
                                                {'c': s1.c + u, 'a': s1.a || ul}, {'c': i3.c + u, 'a': i3.a || ul}])
                        ELSE {'c': i2.c + 4, 'a': i2.a || 'D'} END,
                   CASE WHEN use THEN list_min([{'c': i3.c + 4, 'a': i3.a || 'D'}, {'c': i2.c + a, 'a': i2.a || al}])
                        ELSE {'c': i3.c + 4, 'a': i3.a || 'D'} END
            FROM (
                SELECT j.*, list_min([s3, {'c': i2.c + 3, 'a': i2.a || 'I'}]) AS i3 FROM (
                    SELECT f.k, r.no, s0, s1, s3, ini, fault NOT IN ('b', 'd') AS use,
                           CASE WHEN fault = 't' THEN 3 ELSE 0 END AS late,
                           CASE WHEN fault = 't' THEN 3 ELSE 0 END + CASE WHEN ini = 'u' THEN 0 ELSE 3 END AS u,
                           CASE WHEN fault = 't' THEN 3 ELSE 0 END + CASE WHEN ini = 'a' THEN 0 ELSE 3 END AS a,
                           CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END AS ul, CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END AS al,
                           list_min([s2, {'c': s0.c + 3, 'a': s0.a || 'I'}, {'c': s1.c + 3, 'a': s1.a || 'I'},
                                     {'c': s3.c + 3, 'a': s3.a || 'I'}]) AS i2
                    FROM f JOIN r ON r.k = f.k AND r.no = f.no + 1) j)),
        done AS (
            SELECT k, list_min([s0, s3, {'c': s2.c + 3, 'a': s2.a || 'I'}, {'c': s1.c + 6, 'a': s1.a || 'II'}]) AS best
            FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY no DESC) AS back FROM f) WHERE back = 1),
        e AS (
            SELECT k, p, edit, sum((edit <> 'I')::INTEGER) OVER w AS no, sum((edit <> 'D')::INTEGER) OVER w AS place,
                   sum((edit <> 'D')::INTEGER) OVER (PARTITION BY k) AS spelt
            FROM (SELECT k, unnest(string_split(best.a, '')) AS edit, unnest(range(1, len(best.a) + 1)) AS p
                  FROM done WHERE best.a <> '')
            WINDOW w AS (PARTITION BY k ORDER BY p)),
        said AS (
            SELECT e.k, string_agg(CASE WHEN edit = 'K' THEN r.role WHEN (place - spelt % 2) % 2 = 1 THEN 'user'
                                        ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END,
                                   chr(10) ORDER BY p) AS said
            FROM e LEFT JOIN r ON r.k = e.k AND r.no = e.no WHERE edit <> 'D' GROUP BY e.k),
        n AS (
            SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
            FROM r GROUP BY k)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
               sha256(coalesce(said, '')) AS repaired_sha256
        FROM c JOIN done USING (k) LEFT JOIN n USING (k) LEFT JOIN said USING (k)""",
}
