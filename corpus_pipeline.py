"""The corpus pipeline: documents that are worth training on, deduplicated, clean and tokenised.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.  All stages
but the last return the columns of ``documents``; the last returns ids and digests of the tokens.

Defined results, stage by stage: a null or empty text is scored like any other and goes if it is
rejected; a null text has no lines and stays null; rows without an id or a text are no near duplicates
and stay, equal rows are one document, and of a class the least id stays; null texts hold no benchmark
item; null texts encode to nothing.  Scores exactly at the cutoff, and lines and items exactly at their
ratio, count as reaching it.  Very long texts are worked on whole.  Empty tables give empty tables, and
other columns, whatever their names, come through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, decontaminate, line_dedup, minhash_dedup, rule_ensemble
from weftline.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learnt from ``labels``, does not reject."""
    model = rule_ensemble.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rule_ensemble.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; exact copies count as one page, a document left without lines stays, empty."""
    return line_dedup.drop_lines(docs, distinct_texts=True).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each class of near duplicates."""
    return minhash_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return bpe.op2(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", benchmark),
    ("byte-level BPE", tokens),
]

#: Two stages are models and samples that SQL cannot express; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again as the next one's input."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.write(docs, name.replace(" ", "-"))
            if before is not None:
                scratch.drop(before)
            before = docs
    return docs
