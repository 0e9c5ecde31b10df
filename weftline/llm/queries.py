"""Registered queries of this subpackage: opN_<name>, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import bpe, centroids, chat, decontaminate, line_dedup, minhash_dedup, pii, quality_rules, repair, rule_ensemble, sharding, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    return quality_rules.op1(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark, sf_dir):
    return bpe.op2(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark, sf_dir):
    return minhash_dedup.op3(table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir):
    return pii.op4(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark, sf_dir):
    return rule_ensemble.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark, sf_dir):
    return sharding.op6(table(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    return decontaminate.op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_formatting(spark, sf_dir):
    return chat.op8(table(spark, sf_dir, "conversations"))


def op9_warc(spark, sf_dir):
    return warc.op9(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark, sf_dir):
    return line_dedup.op10(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark, sf_dir):
    return suffix_dedup.op11(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark, sf_dir):
    return repair.op12(table(spark, sf_dir, "conversations"))


def op13_centroid_clustering(spark, sf_dir):
    return centroids.op13(table(spark, sf_dir, "embeddings"))


def quality_ablations(spark, sf_dir):
    """What each policy of op1 keeps, whole and without each of its rules, from the ledger's bits."""
    return quality_rules.ablations(quality_rules.ledger(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_byte_bpe, op3_near_dedup, op4_pii, op5_quality_classifier, op6_sharding, op7_decontamination,
        op8_chat_formatting, op9_warc, op10_line_dedup, op11_suffix_dedup, op12_structure_repair, op13_centroid_clustering, quality_ablations,
    )
}
#: Queries that SQL can express; the others are tested against brute force.
ORACLE_SQL = {
    "op1_quality_rules": quality_rules.ORACLE,
    "quality_ablations": quality_rules.ABLATIONS,
    "op7_decontamination": decontaminate.ORACLE,
    "op8_chat_formatting": chat.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
}
