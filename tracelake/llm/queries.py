"""Registered queries of this package: opN_<name>(spark, sf_dir) -> DataFrame, and their DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import bloom_lm, byte_bpe, decontaminate, html_text, itq_dedup, line_dedup, quality_crf, ranked_search, simhash_dedup, spelling, token_counts, token_files, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = simhash_dedup.near_dedup(_table(spark, sf_dir, "documents"))
    return marks.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = quality_crf.held_out()
    return quality_crf.quality(docs, quality_crf.train(docs.where(~fold), labels.where(~fold)))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_dedup(_table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.line_report(docs, line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), words=True)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), min_chars=7, min_count=2, drop_one_in=31, times=10)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_bloom_lm": op4_bloom_lm,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_quality_crf": op7_quality_crf,
    "op8_itq_dedup": op8_itq_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_token_files": op11_token_files,
    "op12_spelling": op12_spelling,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE = {
    "op6_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        g AS (SELECT *, payload_bytes >= 1000 AND page_id < max(page_id) OVER same AS again, max(page_id) OVER same AS top
            FROM p WINDOW same AS (PARTITION BY payload_digest))
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN top END AS refers_to
        FROM g
    """,
    "op8_itq_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        link AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
        comp AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
        n AS (SELECT x AS vec_id, count(*) AS n_links FROM link GROUP BY x)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
    """,
    "op9_line_dedup": """
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
        keyed AS (
            SELECT doc_id, line, pos,
                translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines),
        common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common c ON keyed.k = c.k
        GROUP BY doc_id
    """,
    "op13_ranked_search": r"""
        WITH low AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
            FROM documents),
        d AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM low),
        tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM d GROUP BY r, doc_id, n, term),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM low WHERE len(terms) > 0),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
        q AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
            FROM benchmark),
        qt AS (SELECT item_id, term, count(*) AS qtf FROM q GROUP BY item_id, term),
        scored AS (
            SELECT item_id, r, any_value(doc_id) AS doc_id,
                CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM qt JOIN w USING (term) JOIN tf USING (term), s
            GROUP BY item_id, r),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
