"""Alignment of two settings of a text, and checks for missing content."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import is_bracket_number, is_placeholder, matching_form
from weftline.operators.ordered import running_offsets, slice_ranges
from weftline.scratch import Scratch

PREFIX = 12


def forward_match(groups: DataFrame, big: str, queries: str) -> DataFrame:
    """[E16] Find queries in order in one long text, each from where the last one left the cursor.

    ``queries`` is an ordered array of strings per row.  A query is sought whole; one longer than
    twelve characters that is not found is sought by its first twelve.  A find moves the cursor on by
    half the query's length, at least one; ``match_length`` is the whole length either way.  An empty or
    null query is not found and leaves the cursor alone.  A fold over the array: sequential within a
    text, side by side across texts.
    """
    none = F.struct(F.lit(False).alias("found"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("match_length"))
    state = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<found:boolean,start:int,match_length:int>>").alias("out"))

    def step(acc: Column, q: Column) -> Column:
        # Each search is done once: a lambda over an array of one element names its result.
        whole = F.when(F.length(q) > 0, F.call_function("locate", q, F.col(big), acc["at"]))
        prefix = F.when(F.length(q) > PREFIX, F.call_function("locate", F.substring(q, 1, PREFIX), F.col(big), acc["at"]))
        hit = F.coalesce(F.nullif(whole, F.lit(0)), F.nullif(prefix, F.lit(0)))
        named = F.transform(F.array(hit), lambda h: F.struct(
            F.when(h.isNotNull(), h + F.greatest(F.lit(1), F.floor(F.length(q) / 2).cast("int"))).otherwise(acc["at"]).alias("at"),
            F.concat(acc["out"], F.array(F.when(h.isNotNull(), F.struct(F.lit(True).alias("found"), (h - 1).alias("start"), F.length(q).alias("match_length"))).otherwise(none))).alias("out"),
        ))
        return F.get(named, 0)

    return groups.withColumn("matches", F.aggregate(queries, state, step, lambda acc: acc["out"]))


class Sought:
    """A part of an ordered list of queries, sought as in ``forward_match``, by an automaton.

    No query is found, whole or by its prefix, in a text that lacks its first twelve characters, and
    one that is not found leaves the cursor alone.  So the first characters of all queries make one
    Aho-Corasick automaton, a text is read by it once, and the queries whose first characters it has met are
    folded in the order of the list, each from the places that were met.
    """

    def __init__(self, queries: list[str | None], first: int = 0):
        self.queries, self.first, self.by_start = queries, first, defaultdict(list)
        self.automaton = ahocorasick.Automaton()
        for k, q in enumerate(queries):
            if q:
                self.by_start[q[:PREFIX]].append(k)
        for start in self.by_start:
            self.automaton.add_word(start, start)
        if self.by_start:
            self.automaton.make_automaton()

    def finds(self, big: str | None, at: int = 0) -> tuple[int, list[tuple[int, int, int]]]:
        """(cursor, (position in the list, start, match_length) of the queries that are found)."""
        if not big or not self.by_start:
            return at, []
        places: dict[str, list[int]] = defaultdict(list)
        for end, start in self.automaton.iter(big):
            places[start].append(end + 1 - len(start))
        out = []
        for k in sorted(k for start in places for k in self.by_start[start]):
            q = self.queries[k]
            ahead = places[q[:PREFIX]]
            ahead = ahead[bisect_left(ahead, at) :]
            hit = next((p for p in ahead if big.startswith(q, p)), ahead[0] if ahead and len(q) > PREFIX else -1)
            if hit >= 0:
                out.append((self.first + k, hit, len(q)))
                at = hit + max(1, len(q) // 2)
        return at, out


#: Characters of queries that are sent to the workers at once.
LIST_CHARS = 16_000_000
FINDS = "cursor int, finds array<struct<pos:int,start:int,match_length:int>>"


def _parts(queries: Iterable[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for q in queries:
        part.append(q)
        size += len(q or "")
        if size >= LIST_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _finder(shared: Broadcast):
    @F.pandas_udf(FINDS)
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sought = Sought(*shared.value)  # once a task
        for text, cursor in batches:
            rows = []
            for x, at in zip(text, cursor.tolist(), strict=True):
                at, hits = sought.finds(x, at)
                rows.append((at, [{"pos": k, "start": a, "match_length": n} for k, a, n in hits]))
            yield pd.DataFrame(rows, columns=["cursor", "finds"])

    return found


def forward_match_all(texts: DataFrame, big: str, queries: Iterable[str | None], scratch: Scratch | None = None) -> DataFrame:
    """[E16] ``forward_match`` of one whole list in every text: the other columns of ``texts``, pos, start and match_length per find.

    The list is read in parts of bounded size.  A list of one part is sought in one pass.  Of a longer one each
    part is sent to the workers, sought, and its finds and the texts' cursors are written before the next part
    is read; so no plan, worker or driver holds more than a part.
    """
    spark = texts.sparkSession
    rest, parts = [c for c in texts.columns if c != big], _parts(queries)
    part, following = next(parts, []), next(parts, None)
    hit = lambda rows: rows.select(*rest, F.explode("_f.finds").alias("_m")).select(*rest, "_m.pos", "_m.start", "_m.match_length")
    if following is None:
        found = _finder(spark.sparkContext.broadcast((part, 0)))
        return hit(texts.withColumn("_f", found(F.col(big), F.lit(0))))
    scratch = scratch or Scratch(spark, "forward")
    numbered = scratch.write(texts.withColumn("_row", F.monotonically_increasing_id()), "texts")
    cursors, first, out = None, 0, []
    while part:
        rows = numbered.withColumn("_cursor", F.lit(0)) if cursors is None else numbered.join(cursors, "_row", "left").withColumn("_cursor", F.coalesce("_cursor", F.lit(0)))
        shared = spark.sparkContext.broadcast((part, first))
        found = scratch.write(rows.withColumn("_f", _finder(shared)(F.col(big), F.col("_cursor"))).drop(big, "_cursor"), "finds")
        shared.unpersist()
        # Texts whose cursor still stands at the start need no row.
        cursors = found.select("_row", F.col("_f.cursor").alias("_cursor")).filter("_cursor > 0")
        out.append(hit(found))
        first += len(part)
        part, following = following or [], next(parts, None)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def deficits(df: DataFrame, source_len: str, target_len: str, at_least: int = 60, ratio: float = 0.97) -> DataFrame:
    """[F8, P6] Rows whose target is shorter than its source by more than ``at_least`` characters and below ``ratio`` of it."""
    rows = df.withColumn("deficit", F.col(source_len) - F.col(target_len)).withColumn("ratio", F.when(F.col(source_len) != 0, F.col(target_len) / F.col(source_len)))
    return rows.filter((F.col(source_len) != 0) & (F.col("deficit") > at_least) & (F.col("ratio") < ratio))


def missing_content(paragraphs: DataFrame, sections: DataFrame, key: str, idx: str, text: str, number: str, root: str, notes: str, placeholder: str, at_least: int = 60, ratio: float = 0.97) -> DataFrame:
    """[C17, E14-E16, E18, F6-F8, P6, G6] Sections of a setting that lack much of what the source has in their range.

    ``paragraphs`` has key, idx and text of sources; ``sections`` key, number, root (text) and notes (array of texts) of
    the other setting.  The roots are sought in order in the source's bare text; a range goes from the paragraph
    of a find to that of the next; its length is that of its paragraphs' bare texts, but for lone numbers in
    brackets and placeholders, a section's that of its root and notes but for placeholders.  Returns key,
    number, start, source_length, target_length, deficit and ratio.
    """
    # Bare texts, places and lengths are made once and written: each is read several times below.
    scratch = Scratch(paragraphs.sparkSession, "missing")
    bare = paragraphs.select(key, idx, matching_form(F.col(text)).alias("_bare"), (~is_bracket_number(F.col(text)) & ~is_placeholder(F.trim(F.col(text)), placeholder)).alias("_count"))
    placed = scratch.write(running_offsets(bare, [key], [idx], F.col("_bare")), "placed")
    own = F.aggregate(F.filter(notes, lambda x: ~is_placeholder(F.trim(x), f"_?{placeholder}_?")), F.lit(0), lambda n, x: n + F.length(matching_form(x)))
    formed = sections.withColumn("_q", matching_form(F.col(root)))
    sections = scratch.write(formed.select(key, number, "_q", (F.length("_q") + own).cast("long").alias("target_length")), "sections")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, "_bare"))), lambda r: r["_bare"]), "")
    wanted = F.array_sort(F.collect_list(F.struct(F.col(number).alias("number"), F.col("_q").alias("q"))))
    groups = placed.groupBy(key).agg(joined.alias("_big")).join(sections.groupBy(key).agg(wanted.alias("_wanted")), key)
    found = forward_match(groups.withColumn("_queries", F.transform("_wanted", lambda w: w["q"])), "_big", "_queries")
    finds = found.select(key, F.inline(F.transform(F.arrays_zip("_wanted", "matches"), lambda m: F.struct(m["_wanted"]["number"].alias(number), m["matches"]["start"].cast("long").alias("_at"))))).filter("_at IS NOT NULL")
    # A place between paragraphs belongs to the later one: paragraphs without a bare text hold no place.
    starts = slice_ranges(finds, placed.filter("end > start").select(key, "start", F.col(idx).cast("long").alias("_para")), [key], "_at", "start", "_para")
    # Of finds in one paragraph the last has the range; the others have none and are left out.
    ranges = scratch.write(starts.groupBy(key, "_para").agg(F.max(number).alias(number)), "ranges")
    points = placed.select(key, F.col(idx).cast("long").alias("_i"), "_count", (F.col("end") - F.col("start")).alias("_l"))
    inside = slice_ranges(points, ranges, [key], "_i", "_para", number).filter(F.col(number).isNotNull())
    lengths = range_lengths(inside, [key], number, "_bare", F.col("_count"), F.col("_l")).withColumnRenamed("length", "source_length")
    both = lengths.join(sections.select(key, number, "target_length"), [key, number]).join(ranges.withColumnRenamed("_para", "start"), [key, number])
    return deficits(both, "source_length", "target_length", at_least, ratio).select(key, number, "start", "source_length", "target_length", "deficit", "ratio")


def range_lengths(points: DataFrame, keys: list[str], name: str, text: str, counts: Column, length: Column) -> DataFrame:
    """Per range or section, the length of what counts: markers and placeholders count as nothing."""
    return points.groupBy(*keys, name).agg(F.sum(F.when(counts, length).otherwise(0)).cast("long").alias("length"))
