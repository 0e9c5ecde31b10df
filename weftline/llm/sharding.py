"""Minimax contiguous partition of atomic groups into shards, in DataFrame operations only.

Rows with equal texts form one atomic group.  Groups stand in the order of a hash of their text; a
shard is a contiguous run of groups.  The smallest capacity C is sought for which cutting greedily
(fill a shard until the next group would pass C) needs no more than ``n_shards`` shards; the shards
are cut there.  This is the least possible largest shard among all contiguous partitions.

How it stays small at any size: group sizes are summed on the map side, so a hot text is one row.
The driver never sees the groups.  It reads one row per *bin* (a run of the hash order with at most
``sqrt(groups)``-like content) and runs the binary search on them; groups are read only from the few
bins in which a cut can fall, because two bounds are proven first:

* if a *fractional* filling (bins may be cut anywhere, groups larger than a bin's share may not)
  needs more than ``n_shards`` shards at C, so does every filling of whole groups;
* if it fits at C, whole groups fit at C plus the largest of the other groups.

Defined results: a null text has size 1 (no bytes, plus 1), belongs to the group of nulls and has
``text_crc32`` null; empty tables give no rows; repeated rows, repeated ids and null ids each take a slot of
their own; very long texts count by their bytes; cuts with equal capacity fall as late as greedy filling puts them; with fewer groups than shards the last shards stay empty; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.scratch import Scratch

KEY_BITS = 60


def order_key(text: Column) -> Column:
    """The place of a text in the order of groups: 60 bits of its MD5, -1 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long"), F.lit(-1).cast("long"))


def greedy(prefix: list[int], capacity: int, n_shards: int) -> list[int] | None:
    """End indices of at most ``n_shards`` runs whose sums stay within ``capacity``; None if there are none.

    ``prefix`` starts with 0 and ends with the total.
    """
    ends, at, last = [], 0, len(prefix) - 1
    for _ in range(n_shards):
        at = bisect_right(prefix, prefix[at] + capacity) - 1
        ends.append(at)
        if at == last:
            return ends
    return None


def minimax(sizes: list[int], n_shards: int) -> tuple[int, list[int]]:
    """(least capacity, end indices) for a list of sizes: binary search over capacities."""
    prefix = [0]
    for s in sizes:
        prefix.append(prefix[-1] + s)
    low, high = max([*sizes, -(-prefix[-1] // n_shards)], default=0), prefix[-1]
    while low < high:
        mid = (low + high) // 2
        if greedy(prefix, mid, n_shards):
            high = mid
        else:
            low = mid + 1
    return low, greedy(prefix, low, n_shards) or []


def _fractional(bins: list[tuple[int, int]], capacity: float, n_shards: int) -> bool:
    """Whether ``n_shards`` runs of ``capacity`` hold the bins; (size, largest atomic group or 0) each."""
    room, used = capacity, 1
    for size, atomic in bins:
        if atomic > capacity:
            return False
        if atomic:
            if atomic > room:
                used, room = used + 1, capacity
            room -= atomic
        else:
            over = size - room
            if over > 0:
                more = math.ceil(over / capacity)
                used += more
                room = more * capacity - over
            else:
                room -= size
        if used > n_shards:
            return False
    return True


def cut_keys(groups: DataFrame, n_shards: int, bin_rows: int = 2_000) -> tuple[int, list[int]]:
    """(capacity, keys at which shards 1, 2, ... begin) for a table (key, size) of groups.

    ``groups`` must be cheap to read again: it is read four times, each time only aggregated.
    """
    n_groups, total, largest = groups.agg(F.count(F.lit(1)), F.sum("size"), F.max("size")).first()
    if not n_groups:
        return 0, []
    n_bins = max(1, min(1 << 20, max(n_groups // bin_rows, math.isqrt(n_groups))))
    width = max(1, (1 << KEY_BITS) // n_bins)
    # Groups of a 2^-10 share of all bytes stand alone: at most 1,024 of them exist.
    heavy = sorted((r.key, r.size) for r in groups.filter(F.col("size") * 1024 >= total).collect())
    light = groups.filter(F.col("size") * 1024 < total)
    edges = F.array(*[F.lit(k) for k, _ in heavy]) if heavy else None
    where = F.floor(F.col("key") / width).cast("long") if width > 1 else F.col("key")
    # A bin ends where a heavy group stands, so heavy groups fall between bins and never inside one.
    past = F.size(F.filter(edges, lambda k: k < F.col("key"))) if heavy else F.lit(0)
    binned = light.withColumn("bin", where).withColumn("past", past)
    rows = binned.groupBy("bin", "past").agg(F.sum("size").alias("size"), F.max("size").alias("most"), F.min("key").alias("key")).collect()
    order = sorted([(r.key, r["size"], 0, r.bin, r.past) for r in rows] + [(k, s, s, None, None) for k, s in heavy])
    parts = [(size, atomic) for _, size, atomic, _, _ in order]
    most_light = max((r.most for r in rows), default=0)

    low, high = max(largest, -(-total // n_shards)), total
    while low < high:  # the least C at which a fractional filling fits
        mid = (low + high) // 2
        low, high = (low, mid) if _fractional(parts, mid, n_shards) else (mid + 1, high)
    bottom, top = low, low + most_light

    prefix = [0]
    for size, _ in parts:
        prefix.append(prefix[-1] + size)

    def reach(start: int, capacity: int, down: bool) -> int:
        """The bin position that a shard from ``start`` reaches: whole bins, rounded down or up."""
        i = bisect_right(prefix, start + capacity) - 1
        return prefix[i] if down else prefix[min(i + 1, len(parts))]

    # Between the least and the greatest place of each cut lie the only bins to look into.
    active: set[int] = set()
    lo_at = hi_at = 0
    for _ in range(n_shards):
        lo_at, hi_at = reach(lo_at, bottom, True), min(total, hi_at + top)
        first, last = bisect_right(prefix, lo_at) - 1, bisect_right(prefix, hi_at) - 1
        active.update(range(max(0, first - 1), min(len(parts), last + 2)))
    wanted = sorted({(order[i][3], order[i][4]) for i in active if order[i][3] is not None})
    inner: dict[tuple, list[tuple[int, int]]] = {}
    if wanted:
        spark = groups.sparkSession
        keep = F.broadcast(spark.createDataFrame(wanted, "bin long, past int"))
        for r in binned.withColumn("past", F.col("past").cast("int")).join(keep, ["bin", "past"], "left_semi").select("bin", "past", "key", "size").collect():
            inner.setdefault((r.bin, r.past), []).append((r.key, r["size"]))
    keys: list[int] = []
    sizes: list[int] = []
    for key, size, _, b, past in order:
        for k, s in sorted(inner.get((b, past), [(key, size)])):
            keys.append(k)
            sizes.append(s)
    prefix = [0]
    for s in sizes:
        prefix.append(prefix[-1] + s)
    low, high = bottom, top
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(prefix, mid, n_shards) else (mid + 1, high)
    ends = greedy(prefix, low, n_shards)
    return low, [keys[e] for e in ends[:-1]]


def shard(df: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text", slot_rows: int = 2_000, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``df``."""
    scratch = scratch or Scratch(df.sparkSession, "shard")
    rows = scratch.write(
        df.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
            order_key(F.col(text_col)).alias("key"), F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    groups = scratch.write(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    _, cuts = cut_keys(groups, n_shards)
    number = F.lit(0)
    for k in cuts:
        number = number + (F.col("key") >= F.lit(k)).cast("int")
    n = rows.count()
    # Slots: rows are dealt over bins by a hash of a number that the written table holds, never by the
    # text or the id, which may be hot; bins of a shard are numbered on, and rows within their bin.
    n_bins = max(1, n // (n_shards * slot_rows))
    placed = rows.withColumn("shard", number).withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(n_bins)).cast("int"))
    counts = placed.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "bin", (F.sum("n").over(Window.partitionBy("shard").orderBy("bin")) - F.col("n")).alias("before"))
    within = Window.partitionBy("shard", "bin").orderBy("doc_id", "key", "row")
    numbered = placed.withColumn("at", F.row_number().over(within))
    return numbered.join(before, ["shard", "bin"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at") - 1).alias("slot")
    )


def op6(df: DataFrame) -> DataFrame:
    """The contract's columns under the law ``bytes``; groups are equal texts."""
    return shard(df).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
