"""Joins and set operations with the reference's rules for order, gaps and repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ordered import global_rank


def zip_positions(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """[G1] One-to-one join on positions; an error, when run, if a position is missing on one side."""
    a, b = left.withColumn("_a", F.lit(1)), right.withColumn("_b", F.lit(1))
    rows = a.join(b, keys, "full")
    return rows.filter(F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.lit("positions do not match"))).otherwise(F.lit(True))).drop("_a", "_b")


def fill_sequence(df: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """[G2] Rows for every number of a range, with nulls where there is none."""
    return df.sparkSession.range(first, last + 1).withColumnRenamed("id", key).join(df, key, "left")


def full_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """[G3, I1] All keys of either side."""
    return left.join(right, keys, "full")


def todo(items: DataFrame, done: DataFrame, keys: list[str], limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """[G10, H3, K2, K3] Items not done yet; a limit counts before done items go, so a resumed limited run may have nothing left."""
    if limit is not None:
        items = items.orderBy(*(order or keys)).limit(limit)
    return items.join(done.select(*keys).distinct(), keys, "left_anti")


def append_new(prior: DataFrame, new: DataFrame) -> DataFrame:
    """[B3, I3]"""
    return prior.unionByName(new, allowMissingColumns=True)


def convert_distinct(df: DataFrame, text: str, convert: Column, out: str) -> DataFrame:
    """[K6] Convert each distinct text once and join the results back, by 128 bits that stand for a text; null gives null."""
    key = F.md5(F.col(text))
    once = df.filter(F.col(text).isNotNull()).groupBy(key.alias("_key")).agg(F.first(text).alias(text)).select("_key", convert.alias(out))
    return df.withColumn("_key", key).join(once, "_key", "left").drop("_key")


def intersect(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """[I6] Keys that both sides have, once each."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_semi")


def matched_sections(matches: DataFrame, sections: DataFrame, number: str) -> DataFrame:
    """[G6] Matches with the section of their number; a match without one is dropped."""
    return matches.join(sections, number)


def match_counts(matches: DataFrame, found: str) -> DataFrame:
    """One row: how many were sought, found and not found."""
    return matches.agg(F.count(F.lit(1)).alias("sought"), F.count_if(found).alias("matched"), F.count_if(~F.col(found)).alias("missing"))


def report_pages(rows: DataFrame, order: list[str], page_rows: int = 20) -> DataFrame:
    """[F18, H4] Rows of a report in a global order, with their place from 1 and the page from 1 that shows them.

    A reader filters on the page; no row holds the whole list, and no task sorts it.
    """
    ranked = global_rank(rows, list(order), "place")
    return ranked.withColumn("page", F.floor((F.col("place") - 1) / page_rows).cast("long") + 1)


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """[H4] The first n rows of a report, by a top-n that sorts no more than that."""
    return df.orderBy(*order).limit(n)


def without_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """[P7] Rows that a decision looks at: all but those of one work; rows without a work stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def within(df: DataFrame, column: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """[P8] Rows whose index lies in one of a few fixed half-open ranges."""
    inside = F.lit(False)
    for a, b in ranges:
        inside = inside | ((F.col(column) >= a) & (F.col(column) < b))
    return df.filter(inside)
