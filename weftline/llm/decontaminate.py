"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

A short item inside a long document has a Jaccard similarity near zero, so the search is for
containment: the share of the item's distinct shingles (five words) that the document has.  An item
with q shingles leaks where at least ``need = ceil(threshold * q)`` of them occur.

Items are partitioned by size (powers of two of q), and each class has an index of its own: the bottom-k
MinHash sketches of its items, where ``k = q - need + 1``, the greatest hash in them and the least ``need``.
A document that holds ``need`` of an item's q shingles misses at most ``q - need``, so it holds one of any k:
the search finds every leak, whatever the document's length.  A document is probed in the classes that
it is large enough for, and verified, by exact counts of distinct shared shingles, against the items of
those classes alone whose index it met.

DataFrame operations only.  Probing and counting are row-local expressions over a document's array
of shingle hashes: no text is shuffled; partial counts are complete before the exchange, as all rows
of a document come from one task.  The indexes enter as constant sets while all items have at most
``MAX_INLINE`` shingles; a larger benchmark is a table, which is broadcast up to ``BROADCAST_BYTES`` and joined
beyond; documents' hashes are then written once, with row numbers that stay.

Defined results: a text with one to four words has one shingle, all its words, and items of that
length are searched among the documents' word runs of the same length; null or empty items and texts
have no shingles and never leak; repeated rows are found each; items with equal texts are found each;
an item exactly at the threshold leaks; very long texts are searched whole; empty tables give no rows;
other columns of documents are not read by the search, and :func:`decontaminate` carries them, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from weftline.llm.rows import packed
from weftline.scratch import Scratch

WIDTH, THRESHOLD = 5, 0.8
MAX_INLINE = 50_000
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda x: x != "")


def with_shingles(df: DataFrame, text: Column, widths: list[int]) -> DataFrame:
    """``df`` with ``_hashes``, hashes of the word runs of the given widths, and ``_row``, a row number.

    Word hashes are made first, as a column that is used more than once, so that Spark keeps it and
    does not split the text again for each shingle.  The row number is not deterministic in Spark's
    eyes, so no filter on ``_hashes`` is pushed below this step and evaluated on the text instead.
    """
    df = df.withColumn("_words", F.transform(words(text), lambda w: F.xxhash64(w)))

    def runs_of(width: int) -> Column:
        last = F.size("_words") - width
        hashed = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(width)], F.lit(width)))
        return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))

    runs = [runs_of(w) for w in widths]
    hashes = F.concat(*runs) if len(runs) > 1 else runs[0]
    return df.select("*", hashes.alias("_hashes"), F.monotonically_increasing_id().alias("_row")).drop("_words")


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(item, width, hashes sorted, q, need, class, sketch) per item that has words."""
    base = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("_text"))
    base = base.withColumn("width", F.least(F.size(words(F.col("_text"))), F.lit(WIDTH))).filter("width > 0")
    parts = [with_shingles(base.filter(F.col("width") == n), F.col("_text"), [n]) for n in range(1, WIDTH + 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("hashes", F.array_sort(F.array_distinct("_hashes"))).withColumn("q", F.size("hashes"))
    # A small allowance keeps products such as 0.8 * 5 from rounding up past their value.
    out = out.withColumn("need", F.ceil(F.lit(threshold) * F.col("q") - F.lit(1e-9)).cast("int"))
    out = out.withColumn("need", F.greatest(F.col("need"), F.lit(1))).withColumn("class", F.floor(F.log2("q")).cast("int"))
    return out.withColumn("sketch", F.slice("hashes", F.lit(1), F.col("q") - F.col("need") + 1)).select("item", "width", "hashes", "q", "need", "class", "sketch")


def size_classes(index: DataFrame) -> list[Row]:
    """(class, top, least, widths, n): a few numbers per size class, never the items themselves."""
    return index.groupBy("class").agg(F.max(F.element_at("sketch", -1)).alias("top"), F.min("need").alias("least"), F.collect_set("width").alias("widths"), F.sum("q").alias("n")).orderBy("class").collect()


def _bounded(table: DataFrame, rows: int) -> DataFrame:
    """``table``, of so many rows of a few numbers, marked for a broadcast if that is small."""
    return F.broadcast(table) if rows * 32 <= BROADCAST_BYTES else table


def _inline(rows: DataFrame, index: DataFrame, classes: list[Row]) -> DataFrame:
    """(_row, doc_id, class, h) of shingles shared with items of the classes in which a document met a sketch."""
    sketches: dict[int, set[int]] = {r["class"]: set() for r in classes}
    for r in index.select("class", "sketch").collect():
        sketches[r["class"]].update(r.sketch)
    every = sorted({h for r in index.select("hashes").collect() for h in r.hashes})
    top, probes = max(r.top for r in classes), sorted(set().union(*sketches.values()))
    # One look at all hashes finds the few that are in any sketch; the classes are probed with those.
    rows = rows.withColumn("_met", F.filter("_hashes", lambda h: (h <= F.lit(top)) & h.isin(probes)))
    rows = rows.filter(F.size("_met") > 0)

    def meets(c: Row) -> Column:
        return (F.size("_hashes") >= c.least) & F.exists("_met", lambda h: (h <= F.lit(c.top)) & h.isin(sorted(sketches[c["class"]])))

    found = F.filter(F.array(*[F.when(meets(c), F.lit(c["class"])) for c in classes]), lambda c: c.isNotNull())
    rows = rows.withColumn("_classes", found).filter(F.size("_classes") > 0)
    shared = F.array_distinct(F.filter("_hashes", lambda h: h.isin(every)))
    return rows.select("_row", "doc_id", "_classes", F.explode(shared).alias("h")).select("_row", "doc_id", F.explode("_classes").alias("class"), "h")


def _joined(rows: DataFrame, index: DataFrame, classes: list[Row], scratch: Scratch) -> DataFrame:
    """The same by joins, for a benchmark of any size."""
    rows = scratch.write(rows.select("_row", "doc_id", "_hashes"), "document-hashes")
    limits = F.broadcast(index.sparkSession.createDataFrame([(r["class"], r.top, r.least) for r in classes], "class int, top long, least int"))
    probes = index.select("class", F.explode("sketch").alias("h")).distinct()
    total = sum(r.n for r in classes)
    top, least = max(r.top for r in classes), min(r.least for r in classes)
    near = rows.filter(F.size("_hashes") >= least).select("_row", F.size("_hashes").alias("n"), F.explode("_hashes").alias("h")).filter(F.col("h") <= top)
    met = near.join(_bounded(probes, total), "h").join(limits, "class").filter((F.col("n") >= F.col("least")) & (F.col("h") <= F.col("top"))).select("_row", "class").distinct()
    met = scratch.write(met, "met")
    of = rows.join(met, "_row").select("_row", "doc_id", "class", F.explode(F.array_distinct("_hashes")).alias("h"))
    known = index.select("class", F.explode("hashes").alias("h")).distinct()
    return of.join(_bounded(known, total), ["class", "h"], "left_semi")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment) for every item that leaks into a document."""
    scratch = scratch or Scratch(docs.sparkSession, "items")
    index = scratch.write(item_shingles(items, item_id, item_text, threshold), "index")
    classes = size_classes(index)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    rows = with_shingles(rows, F.col("_text"), sorted({w for r in classes for w in r.widths}) or [WIDTH]).drop("_text")
    total = sum(r.n for r in classes)
    if not classes:
        hits = rows.filter("false").select("_row", "doc_id", F.lit(0).alias("class"), F.lit(0).cast("long").alias("h"))
    elif total <= MAX_INLINE:
        hits = _inline(rows, index, classes)
    else:
        hits = _joined(rows, index, classes, scratch)
    shingles = index.select("class", "item", "q", "need", F.explode("hashes").alias("h"))
    counted = hits.join(_bounded(shingles, total), ["class", "h"]).groupBy("_row", "doc_id", "item", "q", "need").agg(F.count(F.lit(1)).alias("n_found"))
    return counted.filter(F.col("n_found") >= F.col("need")).select(
        "doc_id", F.col("item").alias("item_id"), F.col("q").cast("long").alias("n_item"), "n_found", (F.col("n_found") / F.col("q")).alias("containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without the documents that an item leaks into; an id that repeats with several texts is as many documents."""
    scratch = scratch or Scratch(docs.sparkSession, "items")
    rows = packed(docs, of=F.struct(F.col(id_col).alias("id"), F.md5(text_col).alias("key")), text=F.col(text_col))
    bad = leaks(rows.select("of", "text"), items, "of", "text", threshold=threshold, scratch=scratch)
    bad = scratch.write(bad.select(F.col("doc_id.id").alias("id"), F.col("doc_id.key").alias("key")).distinct(), "leaked")
    few = F.broadcast(bad) if bad.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else bad
    return rows.join(few, F.col("of.id").eqNullSafe(F.col("id")) & (F.col("of.key") == F.col("key")), "left_anti").select("row.*")


def op7(docs: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(docs, items)


ORACLE = r"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(len(ws), 5) AS width FROM bw WHERE len(ws) > 0),
b AS (SELECT DISTINCT item_id, width, list_slice(ws, i, i + width - 1) AS g FROM (SELECT item_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM bi)),
q AS (SELECT item_id, count(*) AS q FROM b GROUP BY item_id),
d AS (SELECT DISTINCT rid, doc_id, list_slice(ws, i, i + width - 1) AS g FROM (SELECT rid, doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i
  FROM w, (SELECT DISTINCT width FROM bi) WHERE len(ws) >= width)),
m AS (SELECT rid, doc_id, item_id, count(*) AS n FROM d JOIN b ON d.g = b.g GROUP BY ALL)
SELECT doc_id, m.item_id, q::BIGINT AS n_item, n::BIGINT AS n_found, n / q AS containment FROM m JOIN q ON m.item_id = q.item_id WHERE n >= ceil(0.8 * q - 1e-9)
"""
