"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from snapmart.llm import byte_bpe, fingerprints, mixing, ngram_join, packing, pii, quality, ranked_search, tool_calls, toxicity, url_filter, warc, whitening
from snapmart.llm.common import documents

#: Vocabulary files of packing and of byte-level BPE; parameters, never part of the repository.
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a vocabulary file on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations`` as a call, linked to the turn that answers it."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return tool_calls.link_tool_calls(tool_calls.turns_as_messages(turns), tool_calls.TURN_TOOLS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside the held-out fold."""
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(toxicity.fold() == 2, F.lit(False))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), F.size("passages").alias("n_passages"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return ngram_join.jaccard_components(documents(spark, sf_dir))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.find_spans(documents(spark, sf_dir))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page after a round trip through WARC archives."""
    return warc.archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("status")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its half-replaced edit."""
    return fingerprints.compare_with_next(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 2048 ids."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base values and verdict of every document."""
    return quality.quality(documents(spark, sf_dir)).drop("lost")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable embedding."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return ranked_search.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    import public_tokenizers

    return byte_bpe.digests(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tool_calls": op1_tool_calls,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_url_filter": op4_url_filter,
    "op5_pii": op5_pii,
    "op6_warc": op6_warc,
    "op7_mixing": op7_mixing,
    "op8_fingerprints": op8_fingerprints,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_ranked_search": op12_ranked_search,
    "op13_byte_bpe": op13_byte_bpe,
}

#: Only what SQL can state and DuckDB runs on whole tables in little time.
ORACLE_SQL: dict[str, str] = {
    "op1_tool_calls": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(text, '') AS text, text AS raw,
                CASE role WHEN 'user' THEN 'ask' WHEN 'assistant' THEN 'answer' WHEN 'system' THEN 'configure' ELSE role END AS name,
                CASE role WHEN 'user' THEN 60 WHEN 'assistant' THEN 150 WHEN 'system' THEN 15 END AS most,
                'call-' || conv_id || '-' || turn AS call_id,
                CASE WHEN turn > 0 THEN 'call-' || conv_id || '-' || (turn - 1) END AS before
            FROM conversations
        ), c AS (
            SELECT t.*, len(list_filter(string_split_regex(t.text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
                a.turn AS result_turn, a.raw AS output, p.call_id AS known
            FROM t LEFT JOIN t a ON a.before = t.call_id LEFT JOIN t p ON t.before = p.call_id
        )
        SELECT conv_id, turn, 0 AS position, call_id, name, 0 AS level, CAST(before IS NOT NULL AS BIGINT) AS n_needs, result_turn,
            concat_ws('; ',
                CASE WHEN before IS NOT NULL AND known IS NULL THEN 'needs an unknown call' END,
                CASE WHEN result_turn IS NULL THEN 'has no result' END,
                CASE WHEN most IS NULL THEN 'unknown tool ' || coalesce(name, 'null') END,
                CASE WHEN most IS NOT NULL AND words < 1 THEN 'words is below 1' END,
                CASE WHEN words > most THEN 'words is above ' || most END) AS errors,
            '{"arguments":{' || CASE WHEN before IS NULL THEN '' ELSE '"after":["' || before || '"],' END
                || '"text":' || CAST(to_json(text) AS VARCHAR) || ',"words":' || words || '},"id":"' || call_id
                || '","name":' || coalesce(CAST(to_json(name) AS VARCHAR), 'null')
                || ',"output":' || coalesce(CAST(to_json(output) AS VARCHAR), 'null') || '}' AS canonical
        FROM c
    """,
    "op10_quality": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
        ), e AS (
            SELECT k, doc_id, text,
                list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM d
        ), g AS (
            SELECT *, list_filter(lines, lambda x:
                regexp_matches(x, '[.!?…:;"'')\]»”。][\x20\x09-\x0D]*$')
                AND NOT regexp_matches(x, '[|>»›•·][^|>»›•·]*[|>»›•·]')
                AND NOT regexp_matches(x, '(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|accept (all )?cookies|enable javascript|lorem ipsum|subscribe to our newsletter|sign up for|log ?in to|click here|share (this|on)|follow us on|skip to (main )?content|copyright ©)')
            ) AS good
            FROM e
        ), w AS (
            SELECT k, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM e
        ), w3 AS (
            SELECT k, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY k ORDER BY i)
        ), twice AS (
            SELECT k, i, c IS NOT NULL AND count(*) OVER (PARTITION BY k, a, b, c) > 1 AS hit FROM w3
        ), covered AS (
            SELECT k, bool_or(hit) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS inside FROM twice
        ), n AS (
            SELECT k, count(*) FILTER (inside) AS n_repeat_words FROM covered GROUP BY k
        ), v AS (
            SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                len(lines) - len(good) AS n_bad_lines,
                length(array_to_string(lines, '')) AS size, length(array_to_string(good, '')) AS left_over
            FROM g LEFT JOIN n USING (k)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bad_lines,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (size = 0 OR 2 * left_over >= size) AS kept
        FROM v
    """,
    "op12_ranked_search": r"""
        WITH i AS (
            SELECT row_number() OVER () AS k, item_id,
                unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), q AS (
            SELECT k, item_id, term, count(*) AS repeats FROM i GROUP BY ALL
        ), d AS (
            SELECT row_number() OVER () AS r, doc_id,
                unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), tf AS (
            SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL
        ), c AS (
            SELECT count(DISTINCT r) AS n_docs, CAST(sum(tf) AS BIGINT) AS total FROM tf
        ), m AS (
            SELECT r, 75 + (25 * CAST(sum(tf) AS BIGINT) * n_docs) // total AS m FROM tf, c GROUP BY r, n_docs, total
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM tf, c WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs
        ), s AS (
            SELECT k, item_id, r, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL
        ), o AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score
            FROM s WHERE score > 0
        )
        SELECT * FROM o WHERE rank <= 20
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), r AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS newest
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN newest <> page_id THEN newest END AS refers_to
        FROM r
    """,
}
