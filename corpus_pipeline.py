"""A training corpus in five steps: quality, repeated lines, near copies, source weights, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsledger.llm.bpe import encode
from obsledger.llm.jaccard import drop_near_duplicates
from obsledger.llm.line_dedup import drop_repeated_lines
from obsledger.llm.line_quality import fit_on_labels, score_documents
from obsledger.llm.mixing import mix_sources
from obsledger.llm.tables import Scratch, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    labels = read(spark, sf_dir, "labels")
    model = fit_on_labels(read(spark, sf_dir, "documents"), labels)
    return score_documents(docs, model).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that other documents hold too stay in the first of them."""
    return drop_repeated_lines(docs).selectExpr(
        "doc_id", "text", "lang", "source", "cast(char_length(text) as bigint) as n_chars"
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's weight asks, in random order."""
    return mix_sources(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as little-endian 32-bit integers, and their number."""
    return encode(docs).select(*COLUMNS, "token_ids", "n_tokens")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# The quality classifier and the Jaccard join are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each is written and read back by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
