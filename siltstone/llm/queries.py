"""The corpus operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm.bestfit_packing import pack_best_fit
from siltstone.llm.chat_format import recover_roles
from siltstone.llm.embedding_dedup import embedding_components
from siltstone.llm.exact_dedup import exact_groups
from siltstone.llm.jaccard_join import jaccard_components
from siltstone.llm.language_id import identify_languages
from siltstone.llm.lexical_search import ranked_search
from siltstone.llm.license_scan import inherit_licences, stated_licences
from siltstone.llm.line_dedup import drop_recurring_lines
from siltstone.llm.mixing import mix_sources
from siltstone.llm.packing import pack_documents
from siltstone.llm.shared import table
from siltstone.llm.token_alignment import alignment_summary
from siltstone.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of repositories, which are sources: a tree of unequal depth, made from the rows.

    Ids fill directories by 1,000, 200, 50 and 10, and a document lies 0 to 4 of these deep. Documents that are a licence
    statement for a twentieth of their words are licence files: at the top of their source if for half of their words,
    else at the top of one of their ranges of ids.
    """
    stated = stated_licences(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    pick = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    share = F.when(F.col("own_licence").isNotNull(), F.col("statement_words") / F.col("text_words"))
    depth = F.when(share >= 0.5, 0).when(share >= 0.05, 1 + pick % 3).otherwise(pick % 5).cast("int")
    name = F.when(share >= 0.05, F.concat(F.lit("LICENSE."), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    ranges = F.array(*[F.expr(f"coalesce(string(doc_id div {n}), '')") for n in (1000, 200, 50, 10)])
    top = F.array(F.lit(""), F.coalesce("source", F.lit("")))
    last = F.array(F.coalesce(name, F.col("doc_id").cast("string"), F.lit("")))
    path = F.array_join(F.concat(top, F.slice(ranges, F.lit(1), depth), last), "/")
    return inherit_licences(stated.select("doc_id", path.alias("path"), "own_licence", "cosine", "statement_words", "text_words"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover_roles(table(spark, sf_dir, "conversations"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_recurring_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", "text")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_summary(table(spark, sf_dir, "documents"))


def op12_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_packing": op2_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_chat_format": op9_chat_format,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_bestfit_packing": op12_bestfit_packing,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
            doc_id = max(doc_id) OVER copies AS kept, text_sha256
        FROM texts WINDOW copies AS (PARTITION BY text_sha256)
    """,
    "op6_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
            FROM words),
        members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
            SELECT a AS node, a AS other FROM links
            UNION
            SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a)
        SELECT sets.doc_id, len(s) AS n_shingles, least(sets.doc_id, coalesce(min(other), sets.doc_id)) AS component_id
        FROM sets LEFT JOIN reach ON sets.doc_id = reach.node
        GROUP BY sets.doc_id, s
    """,
    "op13_lexical_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        asked AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark) AS i
            GROUP BY ALL),
        sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
        lengths AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // length AS m FROM sizes, totals),
        held AS (
            SELECT doc_id, term, count(*) AS tf FROM terms
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM held, totals GROUP BY term, docs),
        scores AS (
            SELECT item_id, doc_id,
                CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (doc_id)
            GROUP BY item_id, doc_id),
        ranked AS (
            SELECT item_id, doc_id, score,
                row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
            FROM scores WHERE score > 0)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
    """,
}
