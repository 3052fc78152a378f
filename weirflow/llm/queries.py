"""The named queries of the corpus operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import (
    decontamination,
    exact_dedup,
    html_template,
    lexical_search,
    near_dup,
    quality,
    secrets,
    sentencepiece_codec,
    sharding,
    spelling_variants,
    toxicity,
    url_filter,
    weighted_sampling,
)
from weirflow.llm.common import fold, table


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    grammar = toxicity.fit(docs, table(spark, folder, "labels"), folds=5, held=0)
    scored = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), toxicity.score(grammar).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


#: The rules that op3 is to judge by.
HOST_RULES = [
    url_filter.HostRule("net", "/", "block"),
    url_filter.HostRule("example.net", "/en/", "allow"),
    url_filter.HostRule("example.com", "/de/", "block"),
    url_filter.HostRule("org", "/fr/", "allow"),
]


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), HOST_RULES).drop("pattern")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = quality.fit(docs, table(spark, folder, "labels"), folds=4, held=2)
    scored = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), quality.score(network).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_template.main_texts(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.link(table(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact_dedup.deduplicate(table(spark, folder, "documents"), exact_dedup.fresh_index(spark))
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return weighted_sampling.with_edits(table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(table(spark, folder, "documents"))


CORPUS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_html_extraction": op6_html_extraction,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_sharding": op10_sharding,
    "op11_lexical_search": op11_lexical_search,
    "op12_fingerprints": op12_fingerprints,
    "op13_spelling_variants": op13_spelling_variants,
}

#: The terms of a text column, as DuckDB says it.
_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
_PATTERNS = " OR ".join(f"regexp_matches(lower(coalesce(url, '')), '{p.expression}')" for p in url_filter.PATTERNS)

CORPUS_ORACLES: dict[str, str] = {
    "op3_url_filter": rf"""
        WITH split AS (
            SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, url,
                   translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
            FROM split
        ), ruled AS (
            SELECT page_id, url, host, path, CASE
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN {_PATTERNS} THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op8_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
        FROM (SELECT doc_id,
                     sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
              FROM documents)
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op11_lexical_search": rf"""
        WITH split AS (
            SELECT doc_id, {_TERMS} AS terms FROM documents
        ), sizes AS (
            SELECT doc_id, len(terms) AS n FROM split WHERE len(terms) > 0
        ), whole AS (
            SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM sizes
        ), items AS (
            SELECT item_id, term, count(*) AS repeats
            FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
        ), counts AS (
            SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM split)
            WHERE term IN (SELECT term FROM items) GROUP BY doc_id, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
            FROM counts, whole GROUP BY term, documents
        ), scores AS (
            SELECT item_id, doc_id, sum(repeats * weight * (
                (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // total))
            ))::BIGINT AS score
            FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole
            GROUP BY item_id, doc_id
        ), ranks AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranks WHERE rank <= 20
    """,
}
