"""The corpus pipeline over ``documents``: five stages, each an operator of ``millrace.llm``.

Every stage gets what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``.

Defined cases: rows with a NULL or empty text pass every filter, and the mix, which takes words, has
none of them; rows with NULL in other columns are rows like others; repeated rows are near duplicates
of each other if they have words; an empty table stays empty. Further columns of any name come out as they went in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, jaccard, mixing, token_files, toxicity
from millrace.session import materialise, scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1

# Trained scores, graph components and tokenizer output have no SQL.
ORACLE_SQL = None


def _filtered(docs: DataFrame, operator) -> DataFrame:
    """What ``operator`` leaves of ``docs``; columns other than id and text ride in a struct, so none can clash."""
    own = ("doc_id", "text")
    rest = [c for c in docs.columns if c not in own]
    left = operator(docs.select(*own, *([F.struct(*rest).alias("given")] if rest else [])))
    return left.select(*[F.col(c) if c in own else F.col("given").getField(c).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _filtered(docs, lambda d: toxicity.toxicity(d, labels).where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _filtered(docs, jaccard.one_per_component)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _filtered(docs, lambda d: decontam.contamination(d, benchmark).where("NOT contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: place, length and checksum of every document's ids."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
