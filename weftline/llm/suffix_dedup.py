"""Suffix-array dedup: remove every byte that a repeated string of ``length`` bytes covers.

The suffixes of all documents are ordered by their first ``length`` bytes by the difference-cover algorithm:
suffixes at two of three places are named by the rank of their byte triples, names of names give the
ranks of 9, 27, 81, ... bytes, the remaining suffixes are merged by the bytes before a named one, and
neighbours in the order are compared.  What makes it run on a corpus is that it is dealt out:

1.  A suffix belongs to its *anchor*, the least hash of the substrings of half the length in its first ``length``
    bytes.  Equal prefixes have equal anchors, and consecutive suffixes mostly share one, so anchors stand for
    runs of suffixes, about one for each ``length / 4`` bytes.  Anchors that occur once hold no repeat.
2.  Runs of one anchor with equal bytes (128 bits of fingerprints) are one *context*, however often it is
    copied; if it occurs twice, all its suffixes are repeated.  One place of each context is kept.
3.  Only anchors with contexts of different bytes need an order.  Their bytes are shuffled by anchor, and each
    task orders the suffixes of its anchors; a suffix that is equal to one of another context is repeated.
4.  An anchor with more than ``hot`` contexts would be too much for a task; its suffixes are dealt out by two
    64-bit fingerprints of their first ``length`` bytes each and counted by them.

Nothing reaches the driver.  Runs, contexts and results are written to the shared folder.  Texts are shuffled once
for those documents that hold contexts of step 3 and once to meet their results.

Defined results: null and empty texts have no bytes; texts shorter than ``length`` have no such string; a
string that overlaps itself counts; rows with equal ids and texts are documents of their own, as any copies;
texts that tie for anything are removed alike, as no copy is preferred; very long texts are worked on in
overlapping pieces of ``PIECE`` bytes; an empty table gives no rows; other columns pass through :func:`drop_repeats`,
whatever their names, and are not read by the search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.workers import give_back
from weftline.llm.wordstats import M1, M2, mix
from weftline.scratch import Scratch

LENGTH = 400
#: Bytes that are hashed at once; longer texts are cut into pieces that overlap.
PIECE = 1 << 18
#: Suffixes of a run at most, so that the first and the last prefix cover all its bytes.
RUN = 256
#: Contexts of an anchor up to which one task orders its suffixes.
HOT = 4_000
#: Bytes that a task orders at once, if its anchors are not larger.
ORDERED = 1 << 20

RUNS = "doc long, key long, start int, n int, anchor long, context long, inner boolean"


def _hashes(data: np.ndarray) -> np.ndarray:
    return mix(data.astype(np.uint64) + np.uint64(1))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two strings from those of both."""
    x = a * M1 + b
    x = (x ^ (x >> np.uint64(32))) * M2
    return x ^ (x >> np.uint64(29))


def substring_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of the substrings of each size that start at each byte (as far as they fit), by doubling."""
    h, power, out = _hashes(data), 1, {}
    for size in sorted(sizes):
        while power * 2 <= size:
            h, power = _join(h[:-power], h[power:]), power * 2
        out[size] = h if power == size else _join(h[: len(h) - (size - power)], h[size - power :])
    return [out[s] for s in sizes]


def window_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    power = 1
    while power * 2 <= width:
        h, power = np.minimum(h[:-power], h[power:]), power * 2
    return h if power == width else np.minimum(h[: len(h) - (width - power)], h[width - power :])


def _pieces(sizes: np.ndarray, length: int, piece: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (row, from, to) of about ``piece`` bytes; pieces of a row overlap by ``length - 1`` bytes."""
    group, held = [], 0
    for row in np.flatnonzero(sizes >= length).tolist():
        size = int(sizes[row])
        for a in range(0, size - length + 1, piece):
            b = min(size, a + piece + length - 1)
            if group and held + b - a > piece:
                yield group
                group, held = [], 0
            group.append((row, a, b))
            held += b - a
    if group:
        yield group


def _runs_of(buffer: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, n, anchor, context, inner) of the runs in pieces that end at ``ends`` in the buffer."""
    half = length // 2
    small, whole = substring_hashes(buffer, (half, length))
    anchor = window_least(small, length - half + 1)
    inside = np.ones(len(whole), bool)
    for e in ends[:-1]:
        inside[max(0, e - length + 1) : e] = False
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    start = np.flatnonzero(new)
    stop = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True)) + 1
    parts = -(-(stop - start) // RUN)
    if len(parts) and parts.max() > 1:
        first = np.repeat(start, parts)
        start, stop = first + RUN * (np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)), np.repeat(stop, parts)
        stop = np.minimum(start + RUN, stop)
    n = stop - start
    context = _join(_join(whole[start], whole[stop - 1]), n.astype(np.uint64))
    # Prefixes that occur twice here: a run may repeat a string within itself.
    ordered = np.sort(whole[inside])
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    inner = np.zeros(len(start), bool)
    if len(twice):
        twice = np.unique(twice)
        at = np.minimum(np.searchsorted(twice, whole), len(twice) - 1)
        found = np.concatenate(([0], np.cumsum((twice[at] == whole) & inside)))
        inner = found[stop] > found[start]
    return start, n, anchor[start], context, inner


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a column of binary values; null ones must have been replaced."""
    large = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets.astype(np.int64)


def _find_runs(length: int, piece: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                data, offsets = _bytes_of(batch.column(2))
                doc, key = (batch.column(i).to_numpy() for i in (0, 1))
                for group in _pieces(np.diff(offsets), length, piece):
                    buffer = np.concatenate([data[offsets[r] + a : offsets[r] + b] for r, a, b in group])
                    ends = np.cumsum([b - a for _, a, b in group])
                    start, n, anchor, context, inner = _runs_of(buffer, ends, length)
                    of = np.searchsorted(ends, start, side="right")
                    row, begin = np.array([g[0] for g in group])[of], np.array([g[1] for g in group])[of]
                    at = start - (ends - np.diff(np.append(0, ends)))[of] + begin
                    columns = [doc[row], key[row], at.astype(np.int32), n.astype(np.int32), anchor.view(np.int64), context.view(np.int64), inner]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in RUNS.split(", ")])
        finally:
            give_back()

    return run


def _ranks(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by their columns, the first most significant."""
    key, top = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        values = int(c.max(initial=0)) + 1
        if top * values >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max(initial=0)) + 1
        key, top = key * values + c, top * values
    return np.unique(key, return_inverse=True)[1]


def _adjacent(ranks: np.ndarray) -> np.ndarray:
    """Whether a suffix has an equal neighbour in the order."""
    order = np.argsort(ranks, kind="stable")
    same = ranks[order[1:]] == ranks[order[:-1]]
    out = np.zeros(len(ranks), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def repeated_suffixes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``starts`` have a first ``length`` bytes that another one of them has too.

    The difference cover modulo 3 is {1, 2}: of any two suffixes, moving on by 0, 1 or 2 bytes brings both to
    places with names.  A suffix at place 0 is compared with one at place 1 by its first byte and the names one
    further on, with one at place 2 by two bytes and the names two further on, and named ones by their names.
    ``data`` must hold ``length`` bytes from each start; prefixes that are not wholly one string's are not asked for.
    """
    data = np.concatenate((data, np.zeros(2 * length + 3, np.uint8))).astype(np.int64)
    span, spans = 3, [3]
    while span * 3 <= length - 2:
        span *= 3
        spans.append(span)

    def parts(size: int) -> tuple[list[int], int]:
        """Offsets, multiples of 3, of the names that cover ``size`` bytes but for the last few, and where those begin."""
        last = (size - span) // 3 * 3
        return sorted({0, min(span, last), last}), last + span

    needed = np.zeros(len(data), bool)
    for skip in range(3):
        offsets, _ = parts(length - skip)
        for o in offsets:
            needed[starts + skip + o] = True
    needed &= np.arange(len(data)) % 3 != 0
    wanted = [needed]
    for s in spans[-2::-1]:
        now = wanted[-1]
        low = now.copy()
        low[s:] |= now[:-s]
        low[2 * s :] |= now[: -2 * s]
        wanted.append(low)
    name = np.zeros(len(data), np.int64)
    for s, mask in zip(spans, reversed(wanted), strict=True):
        at = np.flatnonzero(mask)
        triple = (data[at], data[at + 1], data[at + 2]) if s == 3 else tuple(name[at + i * (s // 3)] for i in range(3))
        name[at] = _ranks(*triple)

    def key(at: np.ndarray, size: int) -> list[np.ndarray]:
        offsets, tail = parts(size)
        return [*(name[at + o] for o in offsets), *(data[at + i] for i in range(tail, size))]

    out, place = np.zeros(len(starts), bool), starts % 3
    for skip, other in ((0, (1, 2)), (1, (0, 1)), (2, (0, 2))):
        of = np.flatnonzero((place == other[0]) | (place == other[1]))
        at = starts[of]
        if len(at):
            out[of] |= _adjacent(_ranks(*(data[at + i] for i in range(skip)), *key(at + skip, length - skip)))
    return out


CONTEXTS = "anchor long, doc long, key long, start int, n int, single boolean, bytes binary, name long"


def _cut(length: int) -> Callable:
    """Contexts with their bytes, from documents with the list of theirs; hot ones as one row for each suffix."""
    names = [x.split()[0] for x in CONTEXTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    doc, key, text, runs = (batch.column(c)[i] for c in range(4))
                    data, doc, key = memoryview(text.as_buffer()), doc.as_py(), key.as_py()
                    rows = []
                    for r in runs.as_py():
                        a, n, single = r["start"], r["n"], r["single"]
                        part = data[a : a + n - 1 + length]
                        if not r["hot"]:
                            rows.append((r["anchor"], doc, key, a, n, single, bytes(part), None))
                            continue
                        whole = substring_hashes(np.frombuffer(part, np.uint8), (length,))[0]
                        second = substring_hashes(np.frombuffer(part, np.uint8) ^ np.uint8(0x5A), (length,))[0]
                        for k, (x, y) in enumerate(zip(whole.view(np.int64).tolist(), second.view(np.int64).tolist(), strict=True)):
                            rows.append((x, doc, key, a + k, 1, single, None, y))
                    for k in range(0, len(rows), 5_000):
                        some = rows[k : k + 5_000]
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in some], t) for c, t in enumerate(kinds)], names=names)
        finally:
            give_back()

    return run


SPANS, SPANS_OF = "doc long, key long, start int, n int", ("doc", "key", "start", "n")


def _order(length: int, ordered: int) -> Callable:
    """(doc, key, start, n): runs of repeated suffixes in contexts that occur once, from contexts sorted by anchor."""
    names = [x.split()[0] for x in SPANS.split(", ")]

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        data = np.concatenate([np.frombuffer(r[5], np.uint8) for r in rows])
        n = np.array([r[3] for r in rows])
        begin = np.cumsum([0, *[len(r[5]) for r in rows]])[:-1]
        first = np.cumsum(n) - n
        starts = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(begin, n)
        marked = repeated_suffixes(data, starts, length) & np.repeat(np.array([r[4] for r in rows]), n)
        of = np.repeat(np.arange(len(rows)), n)
        edge = np.flatnonzero(marked & np.append(True, ~marked[:-1] | (of[1:] != of[:-1])))
        last = np.flatnonzero(marked & np.append(~marked[1:] | (of[1:] != of[:-1]), True))
        row = of[edge]
        columns = [[rows[i][0] for i in row], [rows[i][1] for i in row], np.array([r[2] for r in rows])[row] + edge - first[row], last - edge + 1]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, anchor = [], 0, None
        try:
            for batch in batches:
                for a, *row in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                    if a != anchor and size >= ordered:
                        yield spans(held)
                        held, size = [], 0
                    anchor = a
                    held.append(row)
                    size += len(row[-1])
            if held:
                yield spans(held)
        finally:
            give_back()

    return run


def _named(id_col: Column, text: Column) -> list[Column]:
    """Two numbers that stand for a row: hashes of its id and of its text."""
    return [F.xxhash64(id_col).alias("doc"), F.xxhash64(text, F.length(text)).alias("key")]


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, piece: int = PIECE, ordered: int = ORDERED, scratch: Scratch | None = None) -> DataFrame:
    """(doc, key, start, n): runs of starts of repeated strings, for rows named by :func:`_named`."""
    if length < 8:
        raise ValueError("strings of fewer than 8 bytes are no repeats worth the search")
    scratch = scratch or Scratch(docs.sparkSession, "suffixes")
    text = F.col(text_col)
    named = docs.filter(F.octet_length(text) >= length).select(*_named(F.col(id_col), text), text.cast("binary").alias("bytes"))
    runs = scratch.write(named.mapInArrow(_find_runs(length, piece), RUNS), "runs")
    anchors = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("copies"), F.min("context").alias("least"), F.max("context").alias("most"), F.max("inner").alias("inner"))
    repeated = anchors.filter("copies > 1 OR inner").select("anchor", (F.col("inner") | (F.col("least") != F.col("most"))).alias("mixed"))
    hits = scratch.write(runs.drop("inner").join(repeated, "anchor"), "repeated")
    scratch.drop(runs)
    place = F.min(F.struct("doc", "key", "start"))
    contexts = hits.filter("mixed").groupBy("anchor", "context", "n").agg(F.count(F.lit(1)).alias("copies"), place.alias("at"))
    contexts = scratch.write(contexts, "contexts")
    whole = hits.filter("NOT mixed").select(*SPANS_OF)
    copied = contexts.filter("copies > 1").select("anchor", "context", "n")
    whole = whole.unionByName(hits.filter("mixed").join(copied, ["anchor", "context", "n"], "left_semi").select(*SPANS_OF))
    large = contexts.groupBy("anchor").agg((F.count(F.lit(1)) > hot).alias("hot"))
    mine = contexts.join(large, "anchor").select("at.doc", "at.key", F.struct("anchor", F.col("at.start").alias("start"), "n", (F.col("copies") == 1).alias("single"), "hot").alias("run"))
    lists = mine.groupBy("doc", "key").agg(F.collect_list("run").alias("runs"))
    cut = scratch.write(named.join(lists, ["doc", "key"]).select("doc", "key", "bytes", "runs").mapInArrow(_cut(length), CONTEXTS), "cut")
    few = cut.filter("bytes IS NOT NULL").drop("name").repartition("anchor").sortWithinPartitions("anchor")
    found = few.mapInArrow(_order(length, ordered), SPANS)
    many = cut.filter("bytes IS NULL").select("anchor", "name", "doc", "key", "start", "n", "single")
    counted = many.groupBy("anchor", "name").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor", "name")
    found = found.unionByName(many.filter("single").join(counted, ["anchor", "name"], "left_semi").select(*SPANS_OF))
    out = scratch.write(whole.unionByName(found), "spans")
    scratch.drop(hits, contexts, cut)
    return out


def covered(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting in the given (start, n) runs cover."""
    out: list[list[int]] = []
    for a, b in sorted((s, s + n - 1 + length) for s, n in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


KEPT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _keep(length: int, with_bytes: bool) -> Callable:
    """What stays of each document; columns that come first pass through as they are."""
    def one(text: pa.Scalar, spans: list[dict] | None) -> tuple:
        data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
        gone = covered([(s["start"], s["n"]) for s in spans or ()], length)
        sha, kept, at = hashlib.sha256(), [], 0
        for a, b in [*gone, (len(data), len(data))]:
            sha.update(data[at:a])
            if with_bytes:
                kept.append(bytes(data[at:a]))
            at = b
        return len(data), sum(b - a for a, b in gone), len(gone), sha.hexdigest(), b"".join(kept) if with_bytes and text.is_valid else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                text, spans = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
                rows = [one(text[i], spans[i].as_py()) for i in range(batch.num_rows)]
                made = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))][: 4 + with_bytes]
                names = [x.split()[0] for x in KEPT.split(", ")] + ["kept"] * with_bytes
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["row", *names])
        finally:
            give_back()

    return run


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_bytes: bool = True, scratch: Scratch | None = None, **limits: int) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept): each row of ``docs`` as a struct (without the text if bytes are not asked for), with what stays of its text's bytes."""
    scratch = scratch or Scratch(docs.sparkSession, "suffixes")
    spans = repeats(docs, id_col, text_col, length, scratch=scratch, **limits).groupBy("doc", "key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    row = F.struct(*[F.col(c) for c in docs.columns if with_bytes or c != text_col]).alias("row")
    named = docs.select(row, *_named(F.col(id_col), F.col(text_col)), F.col(text_col).cast("binary").alias("bytes"))
    schema = f"row {dict(named.dtypes)['row']}, {KEPT}" + ", kept binary" * with_bytes
    return named.join(spans, ["doc", "key"], "left").select("row", "bytes", "spans").mapInArrow(_keep(length, with_bytes), schema)


def op11(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    out = drop_repeats(docs.select("doc_id", "text"), with_bytes=False)
    return out.select(F.col("row.doc_id").alias("doc_id"), *[x.split()[0] for x in KEPT.split(", ")])
