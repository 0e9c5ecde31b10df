"""Quality checks: dispositions, sanity report, page validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X

#: Fixed values of the page check: fewer characters are nearly none; a page this far below the mean is flagged.
NEAR_EMPTY, SHORT_SHARE = 20, 0.3


def page_status(df: DataFrame, length: Column) -> DataFrame:
    """status and reason per page, against the mean length of all pages (one small aggregate, broadcast)."""
    mean = df.agg(F.avg(length).alias("mean_length"))
    rows = df.join(F.broadcast(mean))
    reason = F.when(length < NEAR_EMPTY, "near-empty").when(length < SHORT_SHARE * F.col("mean_length"), "significantly below average")
    return rows.withColumn("reason", reason).withColumn("status", F.when(reason.isNull(), "ok").otherwise("flagged"))


def disposition(x: Column) -> Column:
    """What happens to a paragraph: skipped, mixed or converted."""
    return F.when(~X.looks_like_sanskrit(x), "skipped").when(X.has_mixed_language(x), "mixed").otherwise("converted")


def sanity(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """[F5, B10] One row: inputs, outputs, whether they match, outputs that mix scripts."""
    # Named before they are counted, so each output is made once and not once for each of its uses.
    rows, out = df.select(before.alias("_in"), after.alias("_out")), F.col("_out")
    return rows.agg(F.count("_in").alias("n_in"), F.count("_out").alias("n_out"), F.count_if(X.has_devanagari(out) & X.has_latin(out)).alias("n_stray")).withColumn("match", F.col("n_in") == F.col("n_out"))
