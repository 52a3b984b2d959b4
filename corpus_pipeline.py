"""Documents to training tokens in five stages, each the decision of one operator of ``riskmart.llm``.

A stage takes the documents that the stage before has kept and returns those it keeps itself,
with the columns of ``documents``; the last returns them with their tokens. Null and empty
texts pass as empty; repeated rows count as copies of one another; an empty table passes as such.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import bpe, decontaminate, exact_dup, near_dup, toxicity
from riskmart.llm.queries import BYTE_BPE
from riskmart.session import tune
from riskmart.sources.scratch import keep


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; labels teach, they do not decide."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_dup.drop_near_copies(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the digest of what decoding gives back."""
    results = ("n_tokens", "ids", "decoded_sha256")
    return bpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN, results=results)


def tuned(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, run with the session settings its plans are made for."""
    return lambda spark, docs, sf_dir: stage(tune(spark), docs, sf_dir)


STAGES = [
    ("toxicity", tuned(reject_toxic)),
    ("exact_dedup", tuned(drop_exact_copies)),
    ("near_dedup", tuned(drop_near_copies)),
    ("decontamination", tuned(drop_benchmark_passages)),
    ("byte_bpe", tuned(tokenize)),
]

# Toxicity scores and token ids cannot be stated in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
