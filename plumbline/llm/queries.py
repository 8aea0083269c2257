"""One query per operator over its whole table, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe_transducer, chat_format, chat_repair, collocations, decontaminate, exact_topk, html_extract, language_id, license_scan, near_dedup, pii, token_store, toxicity
from plumbline.llm.common import read, shared_folder

#: Vocabulary files; a caller with files elsewhere uses the operators' own parameters.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return token_store.digests(docs, TOKENIZER, shared_folder(spark, "tokens"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn_weights(pages))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.digests(read(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.fit(docs))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return chat_repair.digests(chat_repair.damage(conversations), conversations)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    hostile = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(rows.union(hostile))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_token_store": op2_token_store,
    "op3_exact_topk": op3_exact_topk,
    "op4_pii": op4_pii,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_html_main_text": op8_html_main_text,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_license_scan": op10_license_scan,
    "op11_chat_repair": op11_chat_repair,
    "op12_collocations": op12_collocations,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
          SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, v.vec_id, CAST(coalesce(list_dot_product(q.x, v.x), 0) AS BIGINT) AS score
          FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5""",
    "op7_minhash_dedup": r"""
        WITH RECURSIVE cut AS (
          SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
          FROM documents
        ), sets AS (
          SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(words) >= 5 THEN [array_to_string(words[i : i + 4], ' ') FOR i IN range(1, len(words) - 3)]
            WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
          FROM cut
        ), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        shared AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
          FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
        ), links AS (
          SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * n_both >= 75 * (s.n + t.n - n_both)
        ), reach AS (
          SELECT doc_id AS a, doc_id AS b FROM cut
          UNION
          SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )
        SELECT cut.doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id, cut.doc_id = least_id AS kept
        FROM cut LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) ON a = cut.doc_id""",
    "op13_chat_formatting": r"""
        WITH given AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), ordered AS (
          SELECT *, lag(role) OVER w AS before, row_number() OVER w AS position, lead(1) OVER w IS NULL AS last
          FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), marked AS (
          SELECT *, role IN ('system', 'user', 'assistant') AS known,
            len(regexp_extract_all(text, '<\\*/?s>|\[\\*(/?SYSTEM_PROMPT|/?INST|/?TURN|SAYS|ANSWER)\]')) AS escapes,
            len(regexp_extract_all(role, '<\\*/?s>|\[\\*(/?SYSTEM_PROMPT|/?INST|/?TURN|SAYS|ANSWER)\]')) AS role_escapes
          FROM ordered
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(3 + sum(length(text) + escapes + CASE role WHEN 'system' THEN 31 WHEN 'user' THEN 13 WHEN 'assistant' THEN 12
            ELSE 19 + length(role) + role_escapes END) AS BIGINT) AS formatted_chars,
          CAST(count(*) FILTER (NOT coalesce(CASE WHEN position = 1 THEN role IN ('system', 'user')
            ELSE (before || '>' || role) IN ('system>user', 'user>assistant', 'assistant>user') END, FALSE))
            + count(*) FILTER (last AND role <> 'assistant') AS BIGINT) AS faults
        FROM marked GROUP BY conv_id""",
}
