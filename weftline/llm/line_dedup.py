"""Site-relative line dedup: drop lines that too large a share of a host's pages carry.

For each host, pages that hold a line are divided by the host's pages; a line whose ratio is at
least ``ratio`` is boilerplate there and is dropped from every page of the host.  The same line may stay on
another host.  One rule holds at all sizes: the ratio decides, with a floor of ``MIN_PAGES`` = 2 pages, as a line
on a single page repeats nowhere.

Only 64-bit line hashes are shuffled, one per page and distinct line, summed on the map side, and the
lines to drop are written once.  A host has at most (mean lines a page / ratio) of them whatever its
size, in ``SLOTS`` short lists by hash, so a line is looked up in one short list.  The table of hosts is
broadcast while its lists have at most ``BROADCAST_BYTES`` (summed, not guessed from the number of hosts);
beyond that the join is an ordinary one, which Spark may split where a host is hot.  Texts are
filtered row by row and never regrouped.

With ``distinct_texts`` a page is a distinct text of its host, in the count of a line and in the host's
total alike: a group of exact copies is then one page, whose own lines are not taken for boilerplate
just because it was copied; the copies are left to near dedup.  Without it each row is a page, which is
what the query's SQL says.

Defined results: a null text stays null, with 0 lines; a line of nothing but white space is never
dropped and never counted; a line exactly at the ratio is dropped; a null host is a host of its own;
repeated rows each count as a page unless ``distinct_texts`` is set; very long texts are split whole;
an empty table gives an empty result; other columns pass through, whatever their names (but :func:`line_dedup`
puts its counts into ``_line_total`` and ``_line_dropped``, in place of columns of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.rows import packed, replaced
from weftline.scratch import Scratch

#: Production parameters of the registered query and the pipeline's stage.
RATIO, MIN_PAGES = 0.02, 2
BROADCAST_BYTES, SLOTS = 32 << 20, 64
#: Fixed value: white space of a line.
WHITE = " \t\n\x0b\x0c\r"


def url_host(url: Column) -> Column:
    """Lower-case host of a URL, without user, port and a leading ``www.``."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.", "")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _blank(line: Column) -> Column:
    return F.length(F.trim(line, F.lit(WHITE))) == 0


def _hashes(text: Column) -> Column:
    """Distinct hashes of a text's lines that hold something other than white space."""
    full = F.filter(_lines(text), lambda x: ~_blank(x))
    return F.array_distinct(F.transform(full, lambda x: F.xxhash64(x)))


def _distinct_pages(pages: DataFrame) -> DataFrame:
    """One row per host and distinct text: two 64-bit hashes and the length stand for the text, its line hashes go with them."""
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.reverse("text")).alias("b"), F.length("text").alias("n")]
    return pages.select("host", *key, _hashes(F.col("text")).alias("hashes")).groupBy("host", "a", "b", "n").agg(F.first("hashes").alias("hashes"))


def boilerplate(df: DataFrame, host_col: str, text_col: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, distinct_texts: bool = False) -> DataFrame:
    """(host, line_hash, n_pages, host_pages) of the lines to drop."""
    pages = df.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    pages = _distinct_pages(pages) if distinct_texts else pages.withColumn("hashes", _hashes(F.col("text")))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).withColumnRenamed("host", "of_host")
    counts = (
        pages.select("host", F.explode("hashes").alias("line_hash"))
        .groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n_pages")).filter(F.col("n_pages") >= min_pages)
    )
    return counts.join(totals, F.col("host").eqNullSafe(F.col("of_host")), "inner").drop("of_host").filter(F.col("n_pages") >= F.lit(ratio) * F.col("host_pages"))


def lists_by_host(lines: DataFrame) -> DataFrame:
    """(_line_host, _line_drop) with a host's hashes in ``SLOTS`` lists."""
    hashes = F.collect_set("line_hash")
    slots = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.filter("h", lambda x: F.pmod(x, F.lit(SLOTS)) == i))
    return lines.groupBy("host").agg(hashes.alias("h")).select(F.col("host").alias("_line_host"), slots.alias("_line_drop"))


def cleaned(df: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, distinct_texts: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """(row, clean, n_lines, n_dropped): each row of ``df`` as a struct, and its text without boilerplate lines."""
    scratch = scratch or Scratch(df.sparkSession, "lines")
    gone = scratch.write(boilerplate(df, host_col, text_col, ratio, min_pages, distinct_texts).select("host", "line_hash"), "boilerplate")
    size = gone.groupBy("host").agg((F.count(F.lit(1)) * 8 + SLOTS * 24 + F.coalesce(F.octet_length("host"), F.lit(0))).alias("b")).agg(F.sum("b")).first()[0] or 0
    drop = lists_by_host(gone)
    if size <= BROADCAST_BYTES:
        drop = F.broadcast(drop)
    out = packed(df, host=F.col(host_col), text=F.col(text_col))
    out = out.join(drop, F.col("host").eqNullSafe(F.col("_line_host")), "left")
    lines = _lines(F.col("text"))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.get("_line_drop", F.pmod(F.xxhash64(x), F.lit(SLOTS)).cast("int")), F.xxhash64(x)) | _blank(x))
    out = out.withColumn("kept", F.when(F.col("_line_drop").isNull(), lines).otherwise(kept))
    total = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    return out.select("row", F.array_join("kept", "\n").alias("clean"), total.alias("n_lines"), F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"))


def drop_lines(df: DataFrame, host_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text_col``."""
    out = cleaned(df, host_col, text_col, **how)
    return out.select(*replaced(out, text_col, F.col("clean")))


def line_dedup(df: DataFrame, host_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The same, plus the counts ``_line_total`` and ``_line_dropped``."""
    out = cleaned(df.drop("_line_total", "_line_dropped"), host_col, text_col, **how)
    return out.select(*replaced(out, text_col, F.col("clean")), F.col("n_lines").alias("_line_total"), F.col("n_dropped").alias("_line_dropped"))


def op10(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the text that stays (host = source)."""
    out = cleaned(df.select("doc_id", "source", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.col("clean").alias("clean_text"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, * FROM documents),
x AS (SELECT rid, doc_id, source, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (SELECT *, string_split(text, chr(10)) AS ls FROM d)),
h AS (SELECT source, count(*) AS n FROM d GROUP BY source),
f AS (SELECT source, line, count(DISTINCT rid) AS c FROM x WHERE trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY source, line),
b AS (SELECT f.source, line FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source WHERE c >= {MIN_PAGES} AND c >= CAST({RATIO} AS DOUBLE) * n),
k AS (SELECT x.*, b.line IS NOT NULL AS gone FROM x LEFT JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.line = b.line)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
  CASE WHEN d.text IS NOT NULL THEN coalesce(clean, '') END AS clean_text
FROM d LEFT JOIN (SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS clean FROM k GROUP BY rid) USING (rid)
"""
