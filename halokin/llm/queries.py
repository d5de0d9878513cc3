"""The registered queries of this subpackage: one per operator, and the pipeline.

Each applies its operator with production parameters to its whole table and
derives the returned digest columns from the operator's output. ``ORACLES`` holds
DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import alignment, decontam, html_text, langid, lines, lm, minhash, oracles, pieces, pii, quality, search, token_files, urls

#: The rules that op7 judges by.
URL_RULES = (
    urls.UrlRule("org", "/", "allow"),
    urls.UrlRule("example.org", "/es/", "block"),
    urls.UrlRule("example.org", "/en/1", "block"),
    urls.UrlRule("com", "/fr/", "allow"),
    urls.UrlRule("com", "/de/", "block"),
)
PII_KEY = "halokin-example-key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality.BASE, "base_failed", "kept", "rule")


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by kind, the digest of the pseudonymised text, and whether the document held personal data."""
    out = pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.size("pii").alias("n_pii"),
                      F.sha2("text", 256).alias("text_sha256"), (F.size("pii") > 0).alias("has_pii"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out("doc_id"))
    model = langid.train(docs.where("NOT held_out"))
    out = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("langs").alias("n_langs"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2("text", 256).alias("text_sha256"))


def op5_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85).drop("node")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded, decoded again and compared; the ids as a checksum."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def listed_urls(pages: DataFrame) -> DataFrame:
    """The list that op7 blocks by: the canonical URL of every page fetched through a campaign link (``utm_source``)."""
    host, path, query = urls.split_url(F.col("url"))
    return pages.where(query.rlike("(^|&)utm_source=")).select(urls.canonical(host, path, query).alias("canonical"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = urls.filter_urls(pages, listed_urls(pages), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op8_lm_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.mark_passages(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_digests(spark, path)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return search.search(index, table(spark, sf_dir, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_pii_pseudonyms, op3_language_mixture, op4_line_dedup, op5_minhash_near_duplicates, op6_sentencepiece, op7_url_filter,
    op8_lm_backoff, op9_decontamination, op10_token_files, op11_ranked_search, op12_tokenizer_alignment, op13_html_text)}
ORACLES = {"op4_line_dedup": oracles.LINE_DEDUP, "op7_url_filter": oracles.URL_FILTER, "op11_ranked_search": oracles.RANKED_SEARCH}
