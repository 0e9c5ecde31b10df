"""Operators over ordered rows: islands, carried values, marker chunks, quotas, spans.

Order is always an explicit column and every window is partitioned by a key (a document, a user), so
sequences are processed side by side.  Survey ids stand in brackets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.text import strip
from weftline.scratch import Scratch


def _upto(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """[J1] (key, idx from 0, line) of a text split at line feeds; empty lines stay."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\r?\n", -1)).alias("idx", "line"))


def islands(df: DataFrame, keys: list[str], order: list[str], tag: str, out: str = "block") -> DataFrame:
    """[E1] Number, from 0, runs of rows with equal tags (null equals null)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = (~F.col(tag).eqNullSafe(F.lag(tag).over(w))) & (F.row_number().over(w) > 1)
    return df.withColumn("_new", changed.cast("int")).withColumn(out, F.sum("_new").over(_upto(keys, order)).cast("long")).drop("_new")


def blocks(df: DataFrame, keys: list[str], idx: str, tag: str, text: str) -> DataFrame:
    """[E1] (keys, block, tag, start, end, text): islands with their texts joined in order."""
    return (
        islands(df, keys, [idx], tag).groupBy(*keys, "block", tag)
        .agg(F.min(idx).alias("start"), F.max(idx).alias("end"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, text))), lambda r: r[text]), "\n").alias("text"))
    )


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """[E6, E10, E31] The last value that is not null, up to and with each row."""
    return df.withColumn(out, F.last(value, ignorenulls=True).over(_upto(keys, order)))


def merge_into_context(df: DataFrame, keys: list[str], order: list[str], tag: str, guest: str, first: str, out: str) -> DataFrame:
    """[E2] Rows tagged ``guest`` take the tag before them; ``first`` where there is none."""
    own = F.when(F.col(tag) != guest, F.col(tag))
    return df.withColumn("_own", own).withColumn(out, F.coalesce(F.last("_own", ignorenulls=True).over(_upto(keys, order)), F.lit(first))).drop("_own")


def tag_groups(df: DataFrame, keys: list[str], idx: str, tag: str, text: str) -> DataFrame:
    """[E3] Texts of equal tags joined, tags ranked by first appearance."""
    grouped = df.groupBy(*keys, tag).agg(
        F.min(idx).alias("first_idx"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, text))), lambda r: r[text]), "\n").alias("text"),
    )
    return grouped.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("first_idx")).cast("long"))


def folded_blocks(df: DataFrame, keys: list[str], idx: str, tag: str, other: str = "other", text: str | None = None) -> DataFrame:
    """[E4] Blocks of equal tags where rows tagged ``other`` belong to the block before them; with their texts, joined by line feeds, if asked for."""
    rows = merge_into_context(df, keys, [idx], tag, other, other, "_tag")
    joined = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, text))), lambda r: r[text]), "\n").alias("text")] if text else []
    return islands(rows, keys, [idx], "_tag").groupBy(*keys, "block", F.col("_tag").alias("tag")).agg(
        F.min(idx).alias("start"), F.max(idx).alias("end"), F.count(F.lit(1)).alias("n"), *joined
    )


def marker_chunks(df: DataFrame, keys: list[str], order: list[str], marker: str, out: str = "chunk") -> DataFrame:
    """[E6] Rows belong to the last marker value that was new; null before the first; markers that repeat open nothing."""
    w = Window.partitionBy(*keys, marker).orderBy(*order)
    fresh = F.when(F.col(marker).isNotNull() & (F.row_number().over(w) == 1), F.col(marker))
    return df.withColumn("_fresh", fresh).withColumn(out, F.last("_fresh", ignorenulls=True).over(_upto(keys, order))).drop("_fresh")


def after_label(df: DataFrame, keys: list[str], order: list[str], is_label: Column, out: str = "after") -> DataFrame:
    """[E7] True from the first label row of a group on."""
    return df.withColumn("_is", is_label.cast("int")).withColumn(out, F.coalesce(F.max("_is").over(_upto(keys, order)) == 1, F.lit(False))).drop("_is")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """[E8] Of rows with equal keys the last one."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """[F16, I4] Of rows with equal keys the first one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def without_repeats(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """[E10] Drop rows whose value equals that of the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_p", F.lag(value).over(w)).withColumn("_k", F.row_number().over(w)).filter((F.col("_k") == 1) | ~F.col(value).eqNullSafe(F.col("_p"))).drop("_p", "_k")


def separator_chunks(df: DataFrame, keys: list[str], order: list[str], is_separator: Column, out: str = "chunk", heading: Column | None = None, first: str = "first_heading") -> DataFrame:
    """[E11] Number, from 1, the runs of rows between separators that are not empty; separators go.

    ``heading``, if given, is one of a key's whole text; it goes to the rows of the key's first chunk, as ``first``.
    """
    if heading is not None:
        rows = separator_chunks(df.withColumn("_h", heading), keys, order, is_separator, out)
        return rows.withColumn(first, F.when(F.col(out) == 1, F.col("_h"))).drop("_h")
    rows = df.withColumn("_s", is_separator.cast("int")).withColumn("_g", F.sum("_s").over(_upto(keys, order))).filter("_s = 0").drop("_s")
    return rows.withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy("_g")).cast("long")).drop("_g")


def sections(rows: DataFrame, key: str, idx: str, line: str, plain: bool = False) -> DataFrame:
    """[E12, E31] Two heading levels: section and sub-section numbers, each from 0, null in preambles.

    A heading is hashes, white space and what follows, trimmed, be it nothing; with ``plain``, hashes,
    one blank and something.
    """
    h2, h3 = (F.col(line).rlike(rf"^{hashes} .") if plain else F.col(line).rlike(rf"^{hashes}\s") for hashes in ("##", "###"))
    rows = rows.withColumn("is_h2", h2).withColumn("is_h3", h3)
    rows = rows.withColumn("_s", F.sum(F.col("is_h2").cast("long")).over(_upto([key], [idx])))
    rows = rows.withColumn("section", F.when(F.col("_s") > 0, F.col("_s") - 1))
    rows = rows.withColumn("_t", F.sum(F.col("is_h3").cast("long")).over(_upto([key, "_s"], [idx])))
    rows = rows.withColumn("sub", F.when((F.col("_s") > 0) & (F.col("_t") > 0), F.col("_t") - 1))
    title = F.when(F.col("is_h2"), strip(F.regexp_replace(line, "^##", "")))
    return rows.withColumn("_h", title).withColumn("heading", F.last("_h", ignorenulls=True).over(_upto([key], [idx]))).drop("_s", "_t", "_h")


def contents(rows: DataFrame, key: str, idx: str, line: str) -> DataFrame:
    """[J8] (key, contents): the tree of a text's headings, sections with their sub-sections in order."""
    heads = sections(rows, key, idx, line).filter(F.col("section").isNotNull() & (F.col("is_h2") | F.col("is_h3")))
    text = strip(F.regexp_replace(line, "^#+", ""))
    subs = F.array_sort(F.collect_list(F.when(F.col("is_h3"), F.struct("sub", text.alias("heading")))))
    one = heads.groupBy(key, "section").agg(F.max(F.when(F.col("is_h2"), text)).alias("heading"), subs.alias("subs"))
    return one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("section", "heading", "subs"))).alias("contents"))


def contents_rows(tree: DataFrame, key: str) -> DataFrame:
    """[J8] A row per section (sub null) and per sub-section, as a table of contents shows them."""
    sections_ = tree.select(key, F.explode("contents").alias("s"))
    below = sections_.select(key, "s.section", F.explode("s.subs").alias("b")).select(key, "section", "b.sub", "b.heading")
    return sections_.select(key, "s.section", F.lit(None).cast("long").alias("sub"), "s.heading").unionByName(below)


def declared_warnings(files: DataFrame, file: str, order: list[str], title: str, declared: str) -> DataFrame:
    """[E13] Sections counted on over ordered files: (number, warning) where a heading declares another number.

    Sections of a file are counted in its own task; the counts of files, one row each, give each file its first
    number, so no window spans more than a file.  A null declared number is none.
    """
    place = F.row_number().over(Window.partitionBy(file).orderBy(*order)).cast("long")
    rows = files.withColumn("_at", place)
    before = running_total(rows.groupBy(file).agg(F.count(F.lit(1)).alias("_n")), [file], "_n", "_before")
    rows = rows.join(before.select(file, "_before"), file).withColumn("number", F.col("_before") + F.col("_at"))
    said = F.concat(F.col(file), F.lit(": heading '"), F.col(title), F.lit("' declares अनुच्छेदः "), F.col(declared).cast("string"), F.lit(" but positional count is "), F.col("number").cast("string"))
    return rows.filter(F.col(declared).isNotNull() & (F.col(declared) != F.col("number"))).select(file, "number", said.alias("warning"))


def declared_mismatches(sections_: DataFrame, keys: list[str], order: list[str], declared: str) -> DataFrame:
    """[E13] Sections numbered by position, where a heading declares another number."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return sections_.withColumn("number", F.row_number().over(w).cast("long")).filter(F.col(declared).isNotNull() & (F.col(declared) != F.col("number")))


def marked_lines(rows: DataFrame, key: str, idx: str, line: str, pattern: str = r'<p class="sutra">(.*?)</p>') -> DataFrame:
    """[J7] (key, idx, section, heading, text): the first marked element of each line, with the section that holds it; headings hold none."""
    rows = sections(rows, key, idx, line).filter(~F.col("is_h2") & F.col(line).rlike(pattern))
    return rows.select(key, idx, F.coalesce("section", F.lit(-1).cast("long")).alias("section"), "heading", strip(F.regexp_extract(line, pattern, 1)).alias("text"))


def running_offsets(df: DataFrame, keys: list[str], order: list[str], text: Column) -> DataFrame:
    """[E14] (start, end) of each row's text in the texts of its key joined in order."""
    df = df.withColumn("_l", F.length(text).cast("long"))
    return df.withColumn("end", F.sum("_l").over(_upto(keys, order))).withColumn("start", F.col("end") - F.col("_l")).drop("_l")


def next_start(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "range_end", close: Column | None = None) -> DataFrame:
    """[A11, E18] The next row's value: the open end of a range that begins here; ``close``, or null, for the last."""
    after = F.lead(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, after if close is None else F.coalesce(after, close))


def out_of_order(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """[E17] Rows whose value is less than the previous row's."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("previous", F.lag(value).over(w)).filter(F.col("previous") > F.col(value))


def neighbours(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """[E19] Values of the rows before and after."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("prev", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))


def join_continued(df: DataFrame, keys: list[str], idx: str, line: str, ends: str, out: str = "line") -> DataFrame:
    """[E20] Lines that end with ``ends`` are glued to what follows, one after another."""
    open_ = F.col(line).endswith(ends)
    w = Window.partitionBy(*keys).orderBy(idx)
    rows = df.withColumn("_b", F.coalesce((~F.lag(open_).over(w)).cast("int"), F.lit(1))).withColumn("_g", F.sum("_b").over(_upto(keys, [idx])))
    bare = F.when(open_, F.expr(f"substring({line}, 1, length({line}) - {len(ends)})")).otherwise(F.col(line))
    return rows.withColumn("_t", bare).groupBy(*keys, "_g").agg(
        F.min(idx).alias(idx), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, "_t"))), lambda r: r["_t"]), "").alias(out), F.count(F.lit(1)).alias("n_lines")
    ).drop("_g")


def verse_breaks(df: DataFrame, keys: list[str], idx: str, line: str, is_end: Column) -> DataFrame:
    """[E21] An empty line after each end row unless an empty one, or nothing, follows; idx gets a second part ``sub``."""
    after = F.lead(line).over(Window.partitionBy(*keys).orderBy(idx))
    add = is_end & F.coalesce(F.trim(after) != "", F.lit(False))
    return df.withColumn("_l", F.when(add, F.array(F.col(line), F.lit(""))).otherwise(F.array(F.col(line)))).select(
        *keys, idx, F.posexplode("_l").alias("sub", line)
    )


def paragraphs(df: DataFrame, keys: list[str], idx: str, line: str) -> DataFrame:
    """[E22] Runs of lines that are not blank, numbered from 1 and joined by line feeds."""
    blank = F.trim(F.col(line)) == ""
    rows = separator_chunks(df, keys, [idx], blank, "para")
    return rows.groupBy(*keys, "para").agg(
        F.min(idx).alias("start"), F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, line))), lambda r: r[line]), "\n").alias("text"),
    )


def open_spans(df: DataFrame, keys: list[str], idx: str, is_start: Column, is_end: Column, text: str) -> DataFrame:
    """[E23] Spans from a start row to the next end row, texts joined by blanks; spans never closed are dropped."""
    before = Window.partitionBy(*keys).orderBy(idx).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_e", is_end.cast("int")).withColumn("_s", is_start.cast("int"))
    rows = rows.withColumn("_g", F.coalesce(F.sum("_e").over(before), F.lit(0)))
    rows = rows.withColumn("_in", F.max("_s").over(_upto([*keys, "_g"], [idx]))).filter("_in = 1")
    spans = rows.groupBy(*keys, "_g").agg(
        F.min(idx).alias("start"), F.max(idx).alias("end"), F.max("_e").alias("_closed"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, text))), lambda r: r[text]), " ").alias("text"),
    )
    return spans.filter("_closed = 1").drop("_closed", "_g")


def segments(df: DataFrame, keys: list[str], order: list[str], is_end: Column, out: str = "segment") -> DataFrame:
    """[E26] Number, from 1, segments that each end with an end row; rows after the last end are dropped."""
    w = Window.partitionBy(*keys)
    before = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_e", is_end.cast("long")).withColumn("_b", F.coalesce(F.sum("_e").over(before), F.lit(0)))
    return rows.withColumn("_t", F.sum("_e").over(w)).filter("_b < _t").withColumn(out, F.col("_b") + 1).drop("_e", "_b", "_t")


def merged_units(items: DataFrame, keys: list[str], idx: str, groups: DataFrame, member: str, first: str) -> DataFrame:
    """[E28] Items whose fixed group (``member``, ``first``) makes them one unit: (keys, unit, n_items), numbered from 1."""
    rows = items.join(groups.select(F.col(member).alias(idx), F.col(first).alias("_first")), idx, "left")
    units = rows.groupBy(*keys, F.coalesce("_first", F.col(idx)).alias("unit")).agg(F.count(F.lit(1)).alias("n_items"))
    return units.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy("unit")).cast("long"))


def checked_counts(units: DataFrame, quotas: DataFrame, keys: list[str], quota: str) -> DataFrame:
    """[E28] The units, or an error, when run, if a key has more or fewer than its quotas say."""
    have = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("_have"))
    want = quotas.groupBy(*keys).agg(F.sum(quota).alias("_want"))
    sums = want.join(have, keys, "full").select(*keys, F.coalesce("_have", F.lit(0)).alias("_have"), F.coalesce("_want", F.lit(0)).alias("_want"))
    fault = F.raise_error(F.concat(F.lit("expected "), F.col("_want"), F.lit(" units, got "), F.col("_have")))
    # A branch of a union that gives no rows: no rewriting of joins can skip it.
    check = sums.filter(F.when(F.col("_have") != F.col("_want"), fault).otherwise(F.lit(False)))
    return units.unionByName(check.select(*keys), allowMissingColumns=True)


def assign_quotas(items: DataFrame, quotas: DataFrame, keys: list[str], number: str, block: str, quota: str, excess: str = "raise") -> DataFrame:
    """[E27, E28] Give the items of each key, numbered from 1, to blocks in order, ``quota`` each.

    Blocks left short at the end are tolerated; items beyond all quotas are an error, when run, or get
    block null if ``excess`` is ``null``.  The range lookup is an as-of window over both tables, not a
    join on inequalities.
    """
    w = _upto(keys, [block])
    starts = quotas.withColumn("_at", F.sum(quota).over(w) - F.col(quota) + 1).filter(F.col(quota) > 0)
    last = quotas.groupBy(*keys).agg(F.sum(quota).alias("_all"))
    marks = starts.select(*keys, F.col("_at").alias(number), F.lit(0).alias("_kind"), F.col(block).alias("_block"))
    rows = marks.unionByName(items.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    rows = rows.withColumn(block, F.last("_block", ignorenulls=True).over(_upto(keys, [number, "_kind"]))).filter("_kind = 1").drop("_kind", "_block")
    rows = rows.join(last, keys, "left")
    beyond = F.lit(None) if excess == "null" else F.raise_error(F.concat(F.lit("more items than quotas: "), F.col(number)))
    return rows.withColumn(block, F.when(F.col(number) <= F.coalesce("_all", F.lit(0)), F.col(block)).otherwise(beyond)).drop("_all")


def slice_ranges(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: str, name: str) -> DataFrame:
    """[E15, G7] The range that each point falls in: ranges begin at ``start`` and end where the next begins."""
    marks = ranges.select(*keys, F.col(start).alias(at), F.lit(0).alias("_kind"), F.col(name).alias("_name"))
    rows = marks.unionByName(points.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    rows = rows.withColumn(name, F.last("_name", ignorenulls=True).over(_upto(keys, [at, "_kind"])))
    return rows.filter("_kind = 1").drop("_kind", "_name")


def dominant(df: DataFrame, keys: list[str], value: str, weight: Column, order: str, default: str) -> DataFrame:
    """[F1, H5] The value with the greatest sum of weights; of equals the one seen first; rows without weight do not count."""
    sums = df.withColumn("_w", weight).filter("_w > 0").groupBy(*keys, value).agg(F.sum("_w").alias("total"), F.min(order).alias("first"))
    best = sums.groupBy(*keys).agg(F.max(F.struct("total", (-F.col("first")).alias("f"), value)).alias("b"))
    return df.select(*keys).distinct().join(best, keys, "left").select(*keys, F.coalesce(f"b.{value}", F.lit(default)).alias(value), F.coalesce("b.total", F.lit(0)).alias("total"))


# Why a row of blocks is left for review.
NO_MAIN = "missing bengali or devanagari block"
NO_LATIN = "no latin (IAST) block found after devanagari"
ONE_LATIN = "only one latin block -- can't distinguish IAST from plain transliteration"
EMPTY_AFTER = "empty bengali or iast after marker-stripping"


def pick_blocks(blocks_: DataFrame, keys: list[str], block: str, tag: str, text: str, main: str = "bengali", second: str = "devanagari", rest: tuple[str, ...] = ("iast", "plain")) -> DataFrame:
    """[E5, C20] Per key: the text of the first ``main`` block, and of the ``rest`` blocks after the first ``second`` block after it all but the last.

    Blocks are as :func:`blocks` gives them, in order of ``block``.  ``reason`` says what a row lacks: the first two
    blocks, any later block of the rest, a second one, or anything but marker lines; its texts are null then.
    """
    w = Window.partitionBy(*keys)
    rows = blocks_.withColumn("_main", F.min(F.when(F.col(tag) == main, F.col(block))).over(w))
    rows = rows.withColumn("_second", F.min(F.when((F.col(tag) == second) & (F.col(block) > F.col("_main")), F.col(block))).over(w))
    later = F.coalesce(F.col(tag).isin(*rest) & (F.col(block) > F.col("_second")), F.lit(False))
    kept = F.array_sort(F.collect_list(F.when(later, F.struct(F.col(block).alias("b"), F.col(text).alias("t")))))
    got = rows.groupBy(*keys).agg(
        F.first("_second").alias("_second"), F.max(F.when(F.col(block) == F.col("_main"), F.col(text))).alias("_m"), kept.alias("_k"),
    )
    clean = lambda x: F.array_join(F.filter(F.split(x, "\n", -1), lambda t: ~t.rlike(r"^[|()0-9\s]+$")), "\n")
    got = got.withColumns({"main": clean(F.col("_m")), "rest": clean(F.array_join(F.transform(F.slice("_k", 1, F.greatest(F.size("_k") - 1, F.lit(0))), lambda r: r["t"]), "\n"))})
    reason = F.when(F.col("_second").isNull(), NO_MAIN).when(F.size("_k") == 0, NO_LATIN).when(F.size("_k") == 1, ONE_LATIN)
    reason = reason.when((strip(F.col("main")) == "") | (strip(F.col("rest")) == ""), EMPTY_AFTER)
    fits = reason.isNull()
    return got.select(*keys, F.when(fits, F.col("main")).alias("main"), F.when(fits, F.col("rest")).alias("rest"), reason.alias("reason"))


def numbered_items(df: DataFrame, keys: list[str], order: list[str], is_chapter: Column, is_section: Column, text: Column) -> DataFrame:
    """[E24, E25] Chapters and their items numbered by position, not by what they say; markers go, items without text are not counted."""
    rows = df.withColumn("_c", is_chapter.cast("long")).withColumn("_s", is_section.cast("long")).withColumn("_t", text)
    rows = rows.withColumn("chapter", F.sum("_c").over(_upto(keys, order))).withColumn("_g", F.sum("_s").over(_upto([*keys, "chapter"], order)))
    rows = rows.filter("_c = 0 and _s = 0").withColumn("_full", F.max((F.trim("_t") != "").cast("int")).over(Window.partitionBy(*keys, "chapter", "_g"))).filter("_full = 1")
    return rows.withColumn("item", F.dense_rank().over(Window.partitionBy(*keys, "chapter").orderBy("_g")).cast("long")).drop("_c", "_s", "_t", "_g", "_full")


def next_run(df: DataFrame, keys: list[str], idx: str, is_marker: Column, in_run: Column, is_blank: Column, reach: int = 400, most: int = 6) -> DataFrame:
    """[E29] For each marker the first run of rows after it within ``reach`` rows, blanks ignored, at most ``most`` rows: their idx values.

    Windows number the rows that are not blank and the runs among them, so only runs, ``most`` rows each at
    most, are gathered, and a marker finds the next one by a look ahead; no row holds its whole reach.
    A run that is open at the marker counts from its first row after the marker.
    """
    w = Window.partitionBy(*keys).orderBy(idx)
    rows = df.withColumn("_at", F.row_number().over(w)).withColumn("_m", is_marker).withColumn("_r", in_run).withColumn("_b", is_blank)
    full = rows.filter(~F.col("_b"))
    wf = Window.partitionBy(*keys).orderBy("_at")
    # Ahead of each row in a run: the rows of it that follow, by the frame of ``most`` rows that are not blank.
    ahead = full.withColumn("_f", F.collect_list(F.struct(F.col("_at").alias("p"), F.col(idx).alias("i"), F.col("_r").alias("r"))).over(wf.rowsBetween(0, most - 1))).filter("_r")
    stop = F.array_position(F.transform("_f", lambda x: x["r"]), False)
    run = F.when(stop > 0, F.filter("_f", lambda x, i: i < stop - 1)).otherwise(F.col("_f"))
    starts = ahead.select(*keys, "_at", run.alias("_run"))
    both = rows.select(*[c for c in df.columns], "_at", "_m").join(starts, [*keys, "_at"], "left")
    after = F.first("_run", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_at").rowsBetween(1, reach - 1))
    found = both.withColumn("_next", after).filter("_m")
    near = F.filter(F.coalesce("_next", F.array().cast("array<struct<p:int,i:bigint,r:boolean>>")), lambda x: x["p"] < F.col("_at") + reach)
    return found.withColumn("run", F.transform(near, lambda x: x["i"])).drop("_at", "_m", "_run", "_next")


def longest_prefix(candidates: DataFrame, known: DataFrame, keys: list[str], parts: str, text: str) -> DataFrame:
    """[G5] Of the prefixes of an array of texts, joined by blanks, the longest that is a known text; its least id."""
    prefixes = candidates.select(*keys, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(parts, 1, n), " ").alias(text)))).alias("p")).select(*keys, "p.*")
    hits = prefixes.join(known, text).groupBy(*keys).agg(F.max(F.struct("n", (-F.col("id")).alias("minus"))).alias("best"))
    return hits.select(*keys, F.col("best.n").alias("n"), (-F.col("best.minus")).alias("id"))


def by_category(entries: DataFrame, work: str, category: str, order: list[str], ranking: list[str]) -> DataFrame:
    """[F16] The first entry of each work; category position in ``ranking`` (unknown and none first, as class -1), then sequence."""
    first = first_per_key(entries, [work], order)
    place = F.array_position(F.array(*map(F.lit, ranking)), F.col(category)) - 1
    return first.withColumn("place", F.coalesce(place, F.lit(-1)).cast("long"))


def running_total(df: DataFrame, order: list[Column | str], value: str, out: str) -> DataFrame:
    """The sum of ``value`` over all rows before each row in a global order, without a window over the whole table.

    Rows are dealt out by range and sorted within their parts; the sums of parts, one row each, give each
    part its start, and a window per part does the rest.  The parts' table is of as many rows as there are
    parts, so it is broadcast.  Rows that tie in ``order`` may stand either way; give an order without ties.
    """
    scratch = Scratch(df.sparkSession, "order")
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.withColumns({n: F.col(o) if isinstance(o, str) else o for n, o in zip(names, order, strict=True)})
    # Written with the number of its part, so that parts stay what they are in both uses.
    parts = scratch.write(keyed.repartitionByRange(*names).withColumn("_part", F.spark_partition_id()), "parts")
    sums = parts.groupBy("_part").agg(F.sum(value).alias("_s"))
    starts = sums.withColumn("_start", F.coalesce(F.sum("_s").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    within = Window.partitionBy("_part").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    rows = parts.withColumn("_w", F.coalesce(F.sum(value).over(within), F.lit(0))).join(F.broadcast(starts), "_part")
    return rows.withColumn(out, (F.col("_start") + F.col("_w")).cast("long")).drop("_part", "_start", "_w", *names)


def global_rank(df: DataFrame, order: list[Column | str], out: str = "rank") -> DataFrame:
    """[H2, H6] Rows numbered from 1 in a global order, parts dealt out and started as in :func:`running_total`.

    A row's number within its part is known once the part is sorted, so it is written with the row: rows are
    shuffled and sorted once, and carry no second copy of what they are sorted by.
    """
    scratch = Scratch(df.sparkSession, "order")
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.withColumns({n: F.col(o) if isinstance(o, str) else o for n, o in zip(names, order, strict=True)})
    parts = scratch.write(keyed.repartitionByRange(*names).sortWithinPartitions(*names).withColumn("_at", F.monotonically_increasing_id()).drop(*names), "parts")
    # The id is the part's number and, in its lower 33 bits, the row's number within the part.
    parts = parts.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return parts.join(F.broadcast(starts), "_part").withColumn(out, (F.col("_start") + F.col("_at") + 1).cast("long")).drop("_part", "_start", "_at")


def rank_within(df: DataFrame, keys: list[str], rank: str, out: str) -> DataFrame:
    """Places from 1 within a key, from a global rank that is sorted by the key first: one aggregate, no window over a key."""
    first = df.groupBy(*keys).agg(F.min(rank).alias("_first"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(first.withColumnsRenamed({k: f"_{k}" for k in keys}), same).withColumn(out, F.col(rank) - F.col("_first") + 1).drop("_first", *[f"_{k}" for k in keys])


def in_shelf_order(works: DataFrame, sequence: str, work: str) -> DataFrame:
    """[F16, H6] Works of :func:`by_category` with their rank in the order of all shelves and on the shelf of their category: by sequence (none as 0), then name."""
    rows = global_rank(works, ["place", F.coalesce(sequence, F.lit(0)), work], "overall")
    return rank_within(rows, ["place"], "overall", "rank")
