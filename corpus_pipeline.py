"""A training-corpus pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to
the shared folder and reads it back for the next stage. All stages but the last return
the columns of ``documents``, with ``n_chars`` brought up to date where the text changes.

1. quality rules: documents that fail the base rule or a learned rule go;
2. line dedup: lines that repeat an earlier line, or are one word's edit from it, go; so
   do documents that had lines and lose them all;
3. MinHash near-dedup (five words, similarity 0.8): one document of each group stays;
4. benchmark decontamination: passages of ``benchmark`` are cut out of the texts;
5. SentencePiece: the texts as ids.

SQL can't express the learned rules, so there is no ORACLE_SQL; the tests hold the pipeline
against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halokin.llm import decontam, lines, minhash, pieces, quality
from halokin.session import materialize

MODEL = "piece_bpe_32k.model"


def _documents(out: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents, n_chars counted anew."""
    chars = F.length("text").cast("long")
    return out.select(*[chars.alias(c) if c == "n_chars" else F.col(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs).where("n_lines = 0 OR n_exact + n_near < n_lines")
    return _documents(out, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _documents(decontam.mark_passages(docs, benchmark, remove=True), docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(MODEL))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", tokenise),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
