"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from barlight.llm.audit import audit
from barlight.llm.contamination import contamination
from barlight.llm.html import extract
from barlight.llm.jaccard import jaccard_components
from barlight.llm.kdtree import top_k
from barlight.llm.language import fold_remainder, identify, train
from barlight.llm.licenses import find_licenses
from barlight.llm.mixing import mix_sources
from barlight.llm.passages import remove_passages
from barlight.llm.scoring import score_documents
from barlight.llm.suffixes import remove_strings
from barlight.llm.tokens import decode, encode
from barlight.llm.turns import repair


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, _read(spark, sf_dir, "benchmark")).select("doc_id", "contaminated", "item_id", "coverage", "n_items")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_read(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_strings(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_licenses(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_passages(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold_remainder(F.col("doc_id")) == 0
    model = train(docs.where(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_read(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    out = decode(ids, path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(_read(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(_read(spark, sf_dir, "documents").select("doc_id", "source", "text"), _read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_decontamination": op2_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_html_extraction": op8_html_extraction,
    "op9_mixing": op9_mixing,
    "op10_top_k": op10_top_k,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op10_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s)
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5""",
    "op6_substring_dedup": """
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d),
        g AS (SELECT doc_id, i, w[i + 1] AS word, CASE WHEN i + 35 <= len(w) THEN array_to_string(w[i + 1 : i + 35], ' ') END AS win FROM p),
        n AS (SELECT win FROM g WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
        f AS (SELECT g.doc_id, g.i, g.word, n.win IS NOT NULL AS hit FROM g LEFT JOIN n ON g.win = n.win),
        c AS (SELECT doc_id, i, word, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM f),
        k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op12_conversation_repair": """
        WITH RECURSIVE crc AS (
          SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, CAST(i AS BIGINT))) AS step),
        k AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        h AS (
          SELECT k.*, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT)),
            lambda c, b: xor(step[1 + (xor(c, b) & 255)], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM k, crc),
        d AS (
          SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM h, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
        f AS (
          SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
            WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '' END AS fault,
            role[1] AS letter, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
        n AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
            count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS turns FROM f GROUP BY conv_id),
        m(q, put, role, q2) AS (VALUES
          (0, '', 's', 1), (0, '', 'u', 2), (1, '', 'u', 2), (3, '', 'u', 2), (2, '', 'a', 3),
          (0, 'user', 'a', 3), (1, 'user', 'a', 3), (3, 'user', 'a', 3), (2, 'assistant', 'u', 2)),
        p(conv_id, i, q, best) AS (
          SELECT conv_id, CAST(0 AS BIGINT), 0, {'c': CAST(0 AS BIGINT), 'a': '', 'r': CAST([] AS VARCHAR[])} FROM n
          UNION ALL
          SELECT conv_id, i, q, min(b) FROM (
            SELECT p.conv_id, f.i, p.q, {'c': best.c + 3, 'a': best.a || 'D', 'r': best.r} AS b
            FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
            UNION ALL
            SELECT p.conv_id, f.i, m.q2,
              {'c': best.c + CASE WHEN put <> '' THEN 2 ELSE 0 END + CASE WHEN letter = m.role THEN 0 ELSE 2 END + CASE WHEN fault = 't' THEN 1 ELSE 0 END,
               'a': best.a || CASE WHEN put <> '' THEN 'I' ELSE '' END || CASE WHEN letter = m.role THEN 'K' ELSE 'R' END,
               'r': best.r || CASE WHEN put <> '' THEN [put || ':'] ELSE [] END || [CASE WHEN letter = m.role THEN f.role WHEN m.role = 'u' THEN 'user' ELSE 'assistant' END || ':' || text]}
            FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1 JOIN m ON p.q = m.q
            WHERE fault NOT IN ('b', 'd') AND (letter = m.role OR m.role <> 's')) GROUP BY conv_id, i, q),
        e AS (
          SELECT p.conv_id, min({'c': best.c + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'a': best.a || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
            'r': best.r || CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END}) AS best
          FROM p JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id AND p.i = n.turns GROUP BY p.conv_id)
        SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op13_filter_audit": """
        WITH d AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        f AS (
          SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
            map {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
                 'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)} AS fails
          FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
        b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        p AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM b a, b b, b c, b d, b e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
        s AS (
          SELECT part, filter_order, step, n, good, toxic, fails[filter_order[step]] AS failing,
            len(list_filter(range(1, step), lambda i: fails[filter_order[i]])) AS before,
            len(list_filter(map_values(fails), lambda v: v)) AS failed
          FROM g, p, (SELECT unnest(range(1, 6)) AS step)),
        r AS (
          SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS x,
            coalesce(sum(n) FILTER (before = 0 AND NOT failing), 0) AS kept, coalesce(sum(n) FILTER (before = 0 AND failing), 0) AS removed,
            coalesce(sum(n) FILTER (before > 0 AND failing), 0) AS redundant, coalesce(sum(n) FILTER (failing AND failed = 1), 0) AS unique_fails,
            coalesce(sum(good) FILTER (before = 0 AND failing), 0) AS good_lost, coalesce(sum(toxic) FILTER (before = 0 AND failing), 0) AS toxic_lost
          FROM s GROUP BY part, filter_order, step)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
          CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
          CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
        FROM r""",
}
