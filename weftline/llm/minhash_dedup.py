"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

Documents are weighted sets of five-word shingles; two are linked where their weighted Jaccard
similarity (sum of lesser weights over sum of greater ones) is at least 0.8, and classes are the
connected components of the links.  A weight is occurrences times idf.  The idf depends on the share of the
documents that have a shingle alone, whatever their number: it is 1 below the share ``HEAVY`` and falls
with the logarithm of the share to 1/2 for a shingle that all documents have:

* the shingles whose idf is below 1 are few whatever the corpus: at most (mean shingles a document /
  HEAVY) of them can exist, so their table is broadcast with a proven bound;
* they are found exactly: mergeable frequent-item summaries with a fixed number of counters give a
  superset, and a second scan counts each of those over all documents.

Signatures: ICWS draws gamma, gamma and uniform variables per shingle and sample.  They are made from
three independent exponentials E1, E2, E3 of the shingle's hash for the sample: c = E1 + E2, r =
ln(c / E1) + E3, beta = E3 / r have the required law, and the value at weight 1 is E1 itself.  So the
usual weight needs one multiplication per shingle and sample and no logarithm; other weights go
through the full formula.  Signatures are banded; a document meets others in a bucket per band value.

From buckets to classes, in two steps that never spell out the pairs of a group:

* *Clusters* are a coarse partition that no link can cross: components of the graph of documents that
  share a bucket and whose byte sketches agree in at least ``MAYBE`` of the samples (a link fails
  that by a chance of 3e-4).  A bucket emits a spanning forest of its part of the graph, at most one
  edge a member.  A bucket with more than ``BUCKET`` members is compared with one leader instead and
  then split by the bands that were not used on its way and in which its members differ, so each
  round brings four more samples to agree on; by the triangle inequality of the Jaccard distance only the
  members that are not near the leader can have links that this misses, so only they go on.
* *Links* are verified exactly inside each cluster, whose texts are brought together once.  A cluster
  beyond ``CLUSTER`` documents or ``CLUSTER_CHARS`` characters is dealt out in blocks of bounded size:
  first every block meets the texts of ``CENTRES`` members, which joins nearly all; the members that
  are not of the first centre's class then meet, block by block, those whose similarity to that centre
  differs from theirs by no more than the triangle inequality lets a link have.  Such members are
  compared with their like one by one: that is their number times the cluster's size at worst.

Defined results: equal texts are one class; null texts and texts without words are alone, except
that equal ones of the latter are one class; a null id has class null; an id that repeats with different
texts is in the least of their classes; ties for leader go to the smaller number; very long texts are
hashed whole, in parts; empty tables give empty results; other columns are not read by the search, and
:func:`keep_one` carries them, whatever their names, in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.components import components
from weftline.llm.rows import packed
from weftline.llm.shingles import shingles
from weftline.llm.wordstats import in_chunks, mix
from weftline.llm.workers import give_back, text_udf
from weftline.scratch import Scratch

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
#: Share of documents from which a shingle counts as heavy, and counters of a summary.
HEAVY, COUNTERS = 0.01, 1 << 17
#: Sketch similarity below which a pair cannot be a link but for a chance of 3e-4.
MAYBE = 0.66
#: For hot buckets: members this similar to the leader are joined with it; the less similar ones (overlapping) go on.
JOINED, ONWARD = 0.30, 0.75
#: Members of a bucket compared in one task; documents and characters of a cluster brought together; members of a block.
BUCKET, CLUSTER, CLUSTER_CHARS, BLOCK, BLOCK_CHARS = 1_024, 1_000, 16_000_000, 1_000, 8_000_000
#: Members that every block of a large cluster meets; width of the shells around the first of them.
CENTRES, SHELL = 4, 0.05
#: Rows of 24 bytes that are broadcast at most.
BROADCAST_IDS = 300_000

_SEED = np.random.Generator(np.random.PCG64(77))
_A = _SEED.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _SEED.integers(0, 1 << 63, SAMPLES, np.uint64)
#: Inverses of ``_A`` modulo 2^64: a sample's hash gives the shingle back.
_BACK = np.array([pow(int(a), -1, 1 << 64) for a in _A], np.uint64)


def idf(share: np.ndarray, heavy: float = HEAVY) -> np.ndarray:
    """1 below the share ``heavy`` of the documents, then down to 1/2 for all of them."""
    return 1 - 0.5 * np.clip(np.log(np.maximum(share, heavy) / heavy) / np.log(1 / heavy), 0, 1)


def weighted(doc: tuple[np.ndarray, np.ndarray], heavy: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, TF-IDF weights); ``heavy`` has sorted shingles and their idf."""
    h, tf = doc
    w = tf.astype(np.float64)
    if len(heavy[0]) and len(h):
        at = np.minimum(np.searchsorted(heavy[0], h), len(heavy[0]) - 1)
        w = np.where(heavy[0][at] == h, w * heavy[1][at], w)
    return h, w


def _exponential(uniform: np.ndarray, bits: int = 64) -> np.ndarray:
    """Exponential variables from whole numbers below ``2 ** bits``, increasing."""
    return -np.log1p(-(uniform.astype(np.float64) + 0.5) * 2.0**-bits * (1 - 2.0**-40))


def signature(h: np.ndarray, w: np.ndarray, block: int = 2_048) -> np.ndarray:
    """``SAMPLES`` consistent weighted samples as 64-bit numbers."""
    best = np.full(SAMPLES, np.inf)
    out = np.zeros(SAMPLES, np.uint64)
    k = np.arange(SAMPLES)
    plain = w == 1.0
    if plain.any():
        least = np.full(SAMPLES, np.iinfo(np.uint64).max)
        ones = h[plain]
        for i in range(0, len(ones), block):
            least = np.minimum((ones[i : i + block, None] * _A + _B).min(0), least)
        best, out = _exponential(least), (least - _B) * _BACK
    others, weights = h[~plain], np.log(w[~plain])
    for i in range(0, len(others), block):
        part = others[i : i + block]
        x = part[:, None] * _A + _B
        one, more = _exponential(x), mix(x)
        c = one + _exponential(more >> np.uint64(32), 32)
        r_beta = _exponential(more & np.uint64(0xFFFFFFFF), 32)
        r = np.log(c / one) + r_beta
        t = np.floor((weights[i : i + block, None] + r_beta) / r)
        a = c * np.exp(r_beta - r * (t + 1))
        low = a.argmin(0)
        a, t = a[low, k], t[low, k].astype(np.int64).astype(np.uint64)
        new = a < best
        best, out = np.where(new, a, best), np.where(new, part[low] ^ mix(t) * (t != 0), out)
    return mix(out ^ _B)


def band_values(sig: np.ndarray) -> np.ndarray:
    """One 64-bit value per band, with the band's number mixed in."""
    rows = sig.reshape(BANDS, ROWS)
    v = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        v = mix(v ^ rows[:, k])
    return v.view(np.int64)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets with sorted keys."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    shared = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


class Postings:
    """Exact similarities of one weighted set with many, by the lists of who has a shingle."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]]):
        self.total = np.array([w.sum() for _, w in docs], np.float64)
        h = np.concatenate([d[0] for d in docs]) if docs else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.h, self.w = h[order], np.concatenate([d[1] for d in docs])[order] if docs else np.zeros(0)
        self.owner = np.repeat(np.arange(len(docs)), np.array([len(d[0]) for d in docs], np.int64))[order]

    def similarities(self, doc: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        h, w = doc
        a, b = np.searchsorted(self.h, h, "left"), np.searchsorted(self.h, h, "right")
        n = b - a
        at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        shared = np.bincount(self.owner[at], np.minimum(self.w[at], np.repeat(w, n)), len(self.total))
        return shared / np.maximum(self.total + w.sum() - shared, 1e-300)


# --- document frequencies --------------------------------------------------------------------------

SUMMARY = "h long, n long"


def _summaries(text_col: str, counters: int, heavy: float):
    """Frequent-item summary of a partition: (shingle, documents counted), and the loss under h = null.

    A shingle that at most the share ``heavy`` / 2 of a partition's documents have is left to the loss, so a
    partition hands on at most (its shingles / that number) rows, whatever it held when it ended.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, lost, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0
        for pdf in batches:
            texts = pdf[text_col].tolist()
            docs += len(texts)
            for s in in_chunks(texts):
                got = [h for h, _ in shingles(texts[s], WIDTH)]
                new, n = np.unique(np.concatenate(got), return_counts=True)
                keys, inverse = np.unique(np.concatenate((keys, new)), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate((counts, n)), len(keys)).astype(np.int64)
                if len(keys) > counters:
                    cut = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
                    lost += cut
                    keep = counts > cut
                    keys, counts = keys[keep], counts[keep] - cut
        cut = max(0, int(heavy * docs / 2) - lost)
        if cut:
            lost += cut
            keep = counts > cut
            keys, counts = keys[keep], counts[keep] - cut
        yield pd.DataFrame({"h": pd.array(keys.view(np.int64), "Int64"), "n": counts})
        yield pd.DataFrame({"h": pd.array([pd.NA], "Int64"), "n": [lost]})
        give_back()

    return run


def _counts(text_col: str, wanted: np.ndarray):
    """Exact document counts of the wanted shingles (sorted) in a partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(wanted), np.int64)
        for pdf in batches:
            texts = pdf[text_col].tolist()
            for s in in_chunks(texts):
                h = np.concatenate([h for h, _ in shingles(texts[s], WIDTH)])
                at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                total += np.bincount(at[wanted[at] == h], minlength=len(wanted))
        give_back()
        some = total > 0
        yield pd.DataFrame({"h": wanted[some].view(np.int64), "n": total[some]})

    return run


def heavy_shingles(docs: DataFrame, text_col: str, heavy: float = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, idf) of all shingles in at least ``heavy`` of the documents, sorted by shingle."""
    texts = docs.select(text_col).filter(F.col(text_col).isNotNull())
    n = texts.count()
    floor = heavy * n
    none = np.zeros(0, np.uint64), np.zeros(0)
    counters = COUNTERS
    while True:
        sums = texts.mapInPandas(_summaries(text_col, counters, heavy), SUMMARY).groupBy("h").agg(F.sum("n").alias("n"))
        # Exact: what a summary lost is at most its loss.  The filter leaves at most
        # shingles / (floor / 4) rows, a number that does not grow with the corpus; below 1 / ``heavy``
        # documents nothing may be lost and every shingle counts as heavy.
        rows = sums.filter(F.col("h").isNull() | (F.col("n") >= F.lit(floor / 4))).collect()
        lost = next((r.n for r in rows if r.h is None), 0)
        if lost <= 0.75 * floor:
            break
        counters *= 4
    wanted = np.sort(np.array([r.h for r in rows if r.h is not None and r.n >= floor - lost], np.int64).view(np.uint64))
    if not len(wanted):
        return none
    got = texts.mapInPandas(_counts(text_col, wanted), SUMMARY).groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= floor).collect()
    keys = np.array([r.h for r in got], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], idf(np.array([r.n for r in got], float)[order] / n, heavy)


# --- signatures, pairs, links ----------------------------------------------------------------------


def _key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def signatures(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n_chars, bands, sketch) per text; ``key`` stands for the text, bands and sketch are null without words."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    @text_udf("bands array<long>, sketch binary")
    def signed(texts: list) -> pd.DataFrame:
        rows = []
        for doc in shingles(texts, WIDTH):
            if len(doc[0]):
                sig = signature(*weighted(doc, shared.value))
                rows.append((band_values(sig), (sig & np.uint64(255)).astype(np.uint8).tobytes()))
            else:
                rows.append((None, None))
        return pd.DataFrame(rows, columns=["bands", "sketch"])

    text = F.col(text_col)
    return docs.filter(text.isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), _key(text).alias("key"), F.length(text).cast("long").alias("n_chars"), signed(text).alias("s")
    ).select("doc_id", "key", "n_chars", "s.bands", "s.sketch")


def _corrected(share: np.ndarray) -> np.ndarray:
    """Sketch similarity from the share of equal bytes, corrected for chance."""
    return (share - 1 / 256) / (1 - 1 / 256)


@F.pandas_udf(T.FloatType())
def sketch_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1)
    return pd.Series(_corrected((x == y).mean(1)).astype(np.float32))


def _between(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sketch similarities of all rows of x with all rows of y, a few rows at a time."""
    out = np.empty((len(x), len(y)), np.float32)
    for i in range(0, len(x), 64):
        out[i : i + 64] = (x[i : i + 64, None] == y[None]).mean(2)
    return _corrected(out)


def _grouped(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups from batches sorted by ``key``: a frame holds one or more complete groups."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        last = pdf[key].iloc[-1]
        open_ = int((pdf[key].to_numpy() == last).argmax())
        if held and held[-1][key].iloc[-1] != pdf[key].iloc[0] or open_:
            whole = pd.concat([*held, pdf.iloc[:open_]], ignore_index=True)
            held = []
            if len(whole):
                yield whole
        held.append(pdf.iloc[open_:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _bounds(values: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal values begin and end."""
    edge = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *edge], [*edge, len(values)], strict=True))


def _spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, member) of a forest that spans a graph given as a matrix."""
    free, out = np.ones(len(near), bool), []
    for root in range(len(near)):
        if not free[root]:
            continue
        free[root], todo = False, [root]
        while todo:
            found = np.flatnonzero(near[todo.pop()] & free)
            free[found] = False
            todo += found.tolist()
            out += [(root, j) for j in found.tolist()]
    return out


EDGES = "u long, v long"


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per bucket, edges that span the graph of similar sketches."""
    for pdf in _grouped(batches, "bucket"):
        node = pdf["node"].to_numpy(np.int64)
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        u, v = [], []
        bounds = np.array(_bounds(pdf["bucket"].to_numpy()))
        pair = bounds[bounds[:, 1] - bounds[:, 0] == 2, 0]
        near = _corrected((sketch[pair] == sketch[pair + 1]).mean(1)) >= MAYBE
        u.append(node[pair[near]])
        v.append(node[pair[near] + 1])
        for a, b in bounds[bounds[:, 1] - bounds[:, 0] > 2]:
            edges = np.array(_spanning(_between(sketch[a:b], sketch[a:b]) >= MAYBE), np.int64).reshape(-1, 2) + a
            u.append(node[edges[:, 0]])
            v.append(node[edges[:, 1]])
        yield pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)}).drop_duplicates()


def _sets(texts: list[str], heavy) -> list[tuple[np.ndarray, np.ndarray]]:
    return [weighted(d, heavy.value) for s in in_chunks(texts) for d in shingles(texts[s], WIDTH)]


def _components_of(docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A number per set, equal for sets that links connect."""
    n = len(docs)
    if n == 2:
        return np.array([0, int(jaccard(docs[0], docs[1]) < SIMILARITY - 1e-9)])
    postings, label, free = Postings(docs), np.arange(n), np.ones(n, bool)
    for root in range(n):
        if not free[root]:
            continue
        free[root], todo = False, [root]
        while todo:
            found = np.flatnonzero((postings.similarities(docs[todo.pop()]) >= SIMILARITY - 1e-9) & free)
            free[found], label[found] = False, root
            todo += found.tolist()
    return label


def _verified(heavy):
    """Per cluster, (node, comp): classes by exact similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _grouped(batches, "cluster"):
            nodes, texts, out = pdf["node"].to_numpy(np.int64), pdf["text"].tolist(), []
            for a, b in _bounds(pdf["cluster"].to_numpy()):
                node, label = nodes[a:b], _components_of(_sets(texts[a:b], heavy))
                least = np.full(b - a, np.iinfo(np.int64).max)
                np.minimum.at(least, label, node)
                out.append(least[label])
            yield pd.DataFrame({"node": nodes, "comp": np.concatenate(out)})
        give_back()

    return run


NEAR_CENTRES = "cluster long, node long, n_chars long, s double, first long, linked array<long>"


def _against_centres(heavy):
    """Per block of a large cluster, whose first rows are the centres: each member's similarity to the first centre, that centre, and the centres that it has links to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _grouped(batches, "block"):
            for a, b in _bounds(pdf["block"].to_numpy()):
                part = pdf.iloc[a:b]
                node, rank, docs = part["node"].to_numpy(np.int64), part["rank"].to_numpy(), _sets(part["text"].tolist(), heavy)
                members, centres = np.flatnonzero(rank < 0), np.flatnonzero(rank >= 0)
                postings = Postings([docs[i] for i in members])
                s = np.array([postings.similarities(docs[i]) for i in centres])
                linked = [node[centres[row]] for row in (s >= SIMILARITY - 1e-9).T]
                yield part.iloc[members][["cluster", "node", "n_chars"]].assign(s=s[0], first=node[centres[0]], linked=linked)
        give_back()

    return run


@F.udf(T.MapType(T.LongType(), T.LongType()))
def _joined(linked):
    """The least of the centres that members join, for each centre; ``linked`` has different lists of at most ``CENTRES``."""
    label = {c: c for centres in linked for c in centres}
    for centres in linked:
        old = {label[c] for c in centres}
        label = {c: min(old) if x in old else x for c, x in label.items()}
    return label


def _linked(heavy):
    """Per pair of blocks of a large cluster: links of the members that ``ask``, as few as join what they join.

    Members with ``done`` are one class already.  A member that asks and is asked has two rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _grouped(batches, "block"):
            for a, b in _bounds(pdf["block"].to_numpy()):
                part = pdf.iloc[a:b]
                node, at = np.unique(part["node"].to_numpy(np.int64), return_index=True)
                asks, done = (np.logical_or.reduceat(part[c].to_numpy(bool), at) for c in ("asks", "done"))
                docs = _sets(part["text"].iloc[at].tolist(), heavy)
                postings, label, out = Postings(docs), np.where(done, -1, node), []
                for x in np.flatnonzero(asks).tolist():
                    linked = np.flatnonzero(postings.similarities(docs[x]) >= SIMILARITY - 1e-9)
                    labels, first = np.unique(label[linked], return_index=True)
                    if len(labels) > 1:
                        out += [(node[x], node[y]) for y in linked[first].tolist() if label[y] != label[x]]
                        label[np.isin(label, labels)] = labels[0]
                yield pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)
        give_back()

    return run


def _bounded(rows: DataFrame, wide: int = 1) -> DataFrame:
    """``rows`` of ids and keys, or ``wide`` times as wide as those, marked for a broadcast if they are few."""
    most = BROADCAST_IDS // wide
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


class _Run:
    """One run over a corpus: its tables and the steps from buckets to classes."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, scratch: Scratch):
        self.spark, self.scratch = docs.sparkSession, scratch
        heavy = heavy_shingles(docs, text_col)
        self.heavy = self.spark.sparkContext.broadcast(heavy)
        signed = scratch.write(signatures(docs, heavy, id_col, text_col), "signatures")
        # Equal texts are one node.  Numbers are given once, in a table that is written, so they are unique and stay.
        same = signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("n_chars", "bands", "sketch")])
        self.nodes = scratch.write(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
        self.ids = scratch.write(signed.select("doc_id", "key"), "ids")
        scratch.drop(signed)
        self.texts = docs.select(F.col(id_col).cast("long").alias("first_id"), F.col(text_col).alias("text"), _key(F.col(text_col)).alias("key"))
        self.sketches = self.nodes.filter("sketch is not null").select("node", "sketch", "n_chars")

    def with_texts(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (with a node, its key and first_id) and the text of each node."""
        ids = _bounded(wanted.select("node", "key", "first_id"))
        one = self.texts.join(ids, ["key", "first_id"]).dropDuplicates(["node"])
        return wanted.drop("key", "first_id").join(one.select("node", "text"), "node")

    def coarse_edges(self) -> tuple[DataFrame | None, DataFrame]:
        """(edges of the coarse graph, company of nodes in their buckets)."""
        # A bucket is named by the hashes of the band values that its members share, so the order of bands
        # does not matter; ``used`` has a bit for each of those bands.
        bands = self.nodes.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "value"))
        bit = F.expr("shiftleft(1L, band)")
        rows = bands.select("node", F.xxhash64("value").alias("bucket"), bit.alias("used"))
        edges, company = None, None
        while True:
            # Ways to a bucket may differ in what was agreed before; bands that all of them used count.
            sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_and("used").alias("used")).filter("n > 1")
            live = self.scratch.write(rows.drop("used").join(sizes, "bucket"), "live")
            if company is None:
                company = self.scratch.write(live.groupBy("node").agg(F.sum("n").alias("company")), "company")
            small = live.filter(F.col("n") <= BUCKET).join(self.sketches.select("node", "sketch"), "node").select("bucket", "node", "sketch")
            found = small.repartition("bucket").sortWithinPartitions("bucket", "node").mapInPandas(_forest, EDGES)
            hot = live.filter(F.col("n") > BUCKET).select("bucket", "node", "used")
            if hot.isEmpty():
                found = self.scratch.write(found, "coarse")
                self.scratch.drop(live)
                return (found if edges is None else edges.union(found)), company
            led = self.scratch.write(hot.join(company, "node").join(self.sketches.select("node", "sketch"), "node"), "led")
            leaders = led.groupBy("bucket").agg(F.max(F.struct("company", (-F.col("node")).alias("minus"), "sketch")).alias("top"))
            leaders = self.scratch.write(leaders.select("bucket", (-F.col("top.minus")).alias("leader"), F.col("top.sketch").alias("of_leader")), "leaders")
            met = led.join(_bounded(leaders, 5), "bucket").filter("node <> leader")
            hot = self.scratch.write(met.select("bucket", "node", "leader", "used", sketch_similarity("sketch", "of_leader").alias("s")), "hot")
            star = hot.filter(F.col("s") >= F.lit(JOINED)).select(F.col("node").alias("u"), F.col("leader").alias("v"))
            found = self.scratch.write(found.union(star), "coarse")
            edges = found if edges is None else edges.union(found)
            # A bucket whose members all joined the leader is one cluster already.
            apart = hot.filter(F.col("s") < F.lit(JOINED)).select("bucket").distinct()
            on = hot.filter(F.col("s") < F.lit(ONWARD)).select("bucket", "node", "used").join(apart, "bucket", "left_semi")
            split = on.join(bands, "node").filter(F.expr("(used & shiftleft(1L, band)) = 0"))
            split = split_ = self.scratch.write(split, "split")
            # Bands in which all of a bucket's members agree tell nothing more; they count as used.
            agreed = split.groupBy("bucket", "band").agg(F.min("value").alias("a"), F.max("value").alias("z"))
            agreed = agreed.filter("a = z").groupBy("bucket").agg(F.bit_or(bit).alias("agreed"))
            split = split.join(_bounded(agreed), "bucket", "left").withColumn("used", F.expr("used | coalesce(agreed, 0L)")).filter("(used & shiftleft(1L, band)) = 0")
            named = F.col("bucket").bitwiseXOR(F.xxhash64("value")).alias("bucket")
            rows = self.scratch.write(split.select("node", named, F.expr("used | shiftleft(1L, band)").alias("used")).groupBy("node", "bucket").agg(F.bit_and("used").alias("used")), "rows")
            self.scratch.drop(live, led, leaders, hot, split_)

    def blocks_of(self, size: str, chars: str) -> Column:
        """In how many blocks of bounded size so many texts of so many characters go."""
        return F.greatest(F.ceil(F.col(size) / BLOCK), F.ceil(F.col(chars) / BLOCK_CHARS)).cast("int")

    def large_classes(self, members: DataFrame) -> DataFrame:
        """(node, comp) of clusters too large to be brought together."""
        members = self.scratch.write(self.with_texts(members).select("cluster", "node", "n_chars", "company", "text"), "large-members")
        by_company = F.struct("company", (-F.col("node")).alias("minus"))
        by_hash = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node")).alias(f"c{k}") for k in range(1, CENTRES)]
        stats = members.groupBy("cluster").agg(F.max(by_company).alias("top"), F.count(F.lit(1)).alias("size"), F.sum("n_chars").alias("chars"), *by_hash)
        centre = (-F.col("top.minus")).alias("c")
        stats = self.scratch.write(stats.select("cluster", "size", "chars", self.blocks_of("size", "chars").alias("n_blocks"), F.array_distinct(F.array(centre, *[F.col(f"c{k}.node") for k in range(1, CENTRES)])).alias("centres")), "stats")
        sizes = _bounded(stats.select("cluster", "n_blocks"))
        dealt = members.join(sizes, "cluster").select("cluster", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("b"), "node", "n_chars", F.lit(-1).alias("rank"), "text")
        centres = stats.select("cluster", "n_blocks", F.posexplode("centres").alias("rank", "node")).join(members.select("node", "n_chars", "text"), "node")
        centres = centres.select("cluster", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("b"), "node", "n_chars", "rank", "text")
        met = dealt.union(centres).withColumn("block", F.xxhash64("cluster", "b"))
        met = met.repartition("block").sortWithinPartitions("block", (F.col("rank") < 0), "rank", "node").select("block", "cluster", "node", "n_chars", "rank", "text")
        found = self.scratch.write(met.mapInPandas(_against_centres(self.heavy), NEAR_CENTRES), "near-centres")
        # Links to centres join members by way of a few centres: there are 2 ** CENTRES different lists of a cluster at most.
        joins = found.filter(F.size("linked") > 0).groupBy("cluster").agg(F.min("first").alias("first"), F.collect_set("linked").alias("linked"))
        joins = self.scratch.write(joins.select("cluster", "first", _joined("linked").alias("label")), "joins")
        placed = found.drop("first").join(_bounded(joins.withColumn("main", F.col("label")[F.col("first")]), 10), "cluster")
        placed = placed.withColumn("comp", F.coalesce(F.col("label")[F.get("linked", 0)], "node"))
        placed = self.scratch.write(placed.select("cluster", "node", "comp", "n_chars", (F.col("comp") == F.col("main")).alias("done"), F.floor(F.col("s") / SHELL).cast("int").alias("shell")), "placed")
        rest = placed.filter(~F.col("done"))
        if rest.isEmpty():
            return placed.select("node", "comp")
        links = self.links_of_rest(members, placed.drop("comp"), rest.drop("comp"))
        return components(links.union(placed.select("node", "comp")), self.scratch)

    def links_of_rest(self, members: DataFrame, placed: DataFrame, rest: DataFrame) -> DataFrame:
        """Links of members that are not of their cluster's main class, each block of them with each block that a link can lead to."""
        near = int(np.ceil((1 - SIMILARITY) / SHELL - 1e-9)) + 1
        count = lambda rows, blocks: rows.groupBy("cluster", "shell").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("c")).select("cluster", "shell", self.blocks_of("n", "c").alias(blocks))
        askers = self.scratch.write(count(rest, "n_ask"), "askers")
        others = self.scratch.write(count(placed, "n_all"), "others")
        in_block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        asking = rest.join(_bounded(askers), ["cluster", "shell"]).withColumn("x", in_block("n_ask"))
        others = others.withColumnsRenamed({"shell": "other"})
        reach = askers.join(_bounded(others), "cluster").filter(F.abs(F.col("shell") - F.col("other")) <= near)
        reach = reach.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n_ask") - 1))).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)))
        # Each pair of blocks of askers and members; a block of askers is as small as their number allows.
        reach = self.scratch.write(reach.select("cluster", "shell", "x", "other", "y", F.xxhash64("cluster", "shell", "x", "other", "y").alias("block")), "reach")
        ask = asking.select("cluster", "shell", "x", "node").join(reach, ["cluster", "shell", "x"]).select("block", "node", F.lit(True).alias("asks"), F.lit(False).alias("done"))
        member = placed.withColumnRenamed("shell", "other").join(_bounded(others), ["cluster", "other"]).withColumn("y", in_block("n_all"))
        answer = member.select("cluster", "other", "y", "node", "done").join(reach, ["cluster", "other", "y"]).select("block", "node", F.lit(False).alias("asks"), "done")
        met = ask.union(answer).join(members.select("node", "text"), "node").select("block", "node", "asks", "done", "text")
        found = met.repartition("block").sortWithinPartitions("block", "node").mapInPandas(_linked(self.heavy), EDGES)
        return self.scratch.write(found, "rest-links")

    def classes(self) -> DataFrame | None:
        """(node, comp) of all nodes that share a cluster with another; None if there are none."""
        edges, company = self.coarse_edges()
        if edges is None or edges.isEmpty():
            return None
        clusters = components(edges, self.scratch).withColumnRenamed("comp", "cluster")
        clusters = self.scratch.write(clusters.join(self.nodes.select("node", "n_chars", "key", "first_id"), "node").join(company, "node"), "clusters")
        sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
        large = sizes.filter((F.col("n") > CLUSTER) | (F.col("chars") > CLUSTER_CHARS)).select("cluster")
        large = self.scratch.write(large, "large")
        small = self.with_texts(clusters.join(large, "cluster", "left_anti").select("cluster", "node", "key", "first_id"))
        found = small.repartition("cluster").sortWithinPartitions("cluster", "node").mapInPandas(_verified(self.heavy), "node long, comp long")
        if not large.isEmpty():
            found = found.union(self.large_classes(clusters.join(large, "cluster", "left_semi")))
        return self.scratch.write(found, "classes")

    def of_keys(self) -> DataFrame:
        """(key, first_id, comp, class_id) of every text."""
        comp, of = self.classes(), self.nodes.select("node", "key", "first_id")
        if comp is None:
            return of.select("key", "first_id", F.col("node").alias("comp"), F.col("first_id").alias("class_id"))
        of = of.join(comp, "node", "left").select("key", "first_id", F.coalesce("comp", "node").alias("comp"))
        return self.scratch.write(of.join(of.groupBy("comp").agg(F.min("first_id").alias("class_id")), "comp").select("key", "first_id", "comp", "class_id"), "of-keys")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, class_id) per row with an id; class_id is the least id of the class."""
    run = _Run(docs, id_col, text_col, scratch or Scratch(docs.sparkSession, "dedup"))
    # An id that repeats with several texts takes the least of their classes.
    out = run.ids.join(run.of_keys().select("key", "class_id"), "key").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    return ids.join(out, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id.

    Rows without an id or a text stay.  Rows that agree in id and text are one document, of which the
    least row (as JSON, so columns of any kind do) stays; an id that repeats with several texts is as many documents.
    """
    scratch = scratch or Scratch(docs.sparkSession, "dedup")
    run = _Run(docs, id_col, text_col, scratch)
    of = run.of_keys()
    # Of a class, the text whose first id is the class's; of several with that id, the least key.
    stays = of.filter("first_id = class_id").groupBy("comp", "class_id").agg(F.min("key").alias("_stays")).select(F.col("_stays").alias("key"), F.col("class_id").alias("doc_id"))
    keep = run.ids.join(stays, ["key", "doc_id"], "left_semi")
    drop = scratch.write(run.ids.join(stays, ["key", "doc_id"], "left_anti").distinct().select("doc_id", "key"), "drop")
    repeats = scratch.write(keep.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "key"), "repeats")
    rows = packed(docs, doc_id=F.col(id_col).cast("long"), key=_key(F.col(text_col)))
    out = rows.join(_bounded(drop), ["doc_id", "key"], "left_anti")
    if repeats.isEmpty():
        return out.select("row.*")
    alone = out.join(_bounded(repeats), ["doc_id", "key"], "left_anti").select("row.*")
    least = out.join(_bounded(repeats), ["doc_id", "key"]).groupBy("doc_id", "key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return alone.unionByName(least.select("row.*"))


def op3(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, and whether the document is the one of its class that stays."""
    return near_duplicates(docs).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
