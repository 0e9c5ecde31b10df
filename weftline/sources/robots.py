"""[A15] Which pages may be fetched, and when: rules of hosts and a schedule, as joins; no page is fetched here.

Rules are a table (host, agent, rule, path): ``rule`` is allow, disallow or crawl-delay (with seconds in
``path``).  Of the rules of a host for the agent, or for ``*`` where the host has none for the agent, the one with
the longest path that begins the page's path decides, allow before disallow among equal ones; an empty
disallow and no rule allow.  A host whose rules could not be read is given one that disallows ``/``.  ``*`` in a path stands for any characters and ``$`` at its end for the end.

The schedule gives each allowed page of a host a second: a page follows the one before it by the host's delay,
and by a seeded random part of ``jitter`` that depends on the page's address alone, so a plan made again is the same.
A host's pages are numbered by range and not by a window, so a host may have any number of them.

Defined results: a null address has no host and is refused as no address; repeated addresses are scheduled
each; hosts are compared without case and port; a host without rules allows all; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ordered import global_rank, rank_within, running_total

#: Seconds between two pages of a host are from one to two.
DELAY, JITTER = 1.0, 1.0
ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]+)?([^#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.lower(F.nullif(F.regexp_extract(url, ADDRESS, 1), F.lit("")))
    path = F.regexp_extract(url, ADDRESS, 2)
    return host, F.when(path == "", "/").otherwise(path)


def _pattern(path: Column) -> Column:
    """A rule's path as a pattern that begins where the page's path does."""
    ends = path.endswith("$")
    body = F.when(ends, F.left(path, F.length(path) - 1)).otherwise(path)
    quoted = F.transform(F.split(body, r"\*", -1), lambda x: F.concat(F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit("")), F.lit(r"\E")))
    return F.concat(F.lit("(?s)^"), F.array_join(quoted, ".*"), F.when(ends, "$").otherwise(""))


def gate(pages: DataFrame, rules: DataFrame, url: str = "url", agent: str = "weftline") -> DataFrame:
    """``pages`` with host, allowed and delay.

    A host's rules are one row, an array, as a rules file is of bounded size; pages are joined with it by
    host, which Spark may split where a host is hot.  Each page tests its host's rules by itself.
    """
    named = F.lower("agent") == agent.lower()
    rule = F.struct(F.length("path").alias("size"), (F.col("rule") == "allow").alias("allow"), _pattern(F.col("path")).alias("pattern"))
    own = rules.filter((named | (F.col("agent") == "*")) & F.col("rule").isNotNull()).withColumn("host", F.lower("host"))
    of = own.groupBy("host", named.alias("mine")).agg(
        F.collect_list(F.when(F.col("rule").isin("allow", "disallow") & (F.col("path") != ""), rule)).alias("rules"), F.max(F.when(F.col("rule") == "crawl-delay", F.expr("try_cast(path AS double)"))).alias("delay"),
    )
    best = of.groupBy("host").agg(F.max_by(F.struct("rules", "delay"), "mine").alias("r")).select(F.col("host").alias("_host"), "r.rules", "r.delay")
    host, path = host_and_path(F.col(url))
    rows = pages.withColumns({"host": host, "_path": path}).join(best, F.col("host") == F.col("_host"), "left").drop("_host")
    hits = F.filter("rules", lambda r: F.regexp_like(F.col("_path"), r["pattern"]))
    top = F.array_max(F.transform(hits, lambda r: F.struct(r["size"].alias("size"), r["allow"].alias("allow"))))
    allowed = F.col("host").isNotNull() & F.coalesce(top["allow"], F.lit(True))
    return rows.withColumn("allowed", allowed).withColumn("delay", F.coalesce("delay", F.lit(DELAY))).drop("_path", "rules")


def schedule(pages: DataFrame, order: str, url: str = "url", jitter: float = JITTER, seed: int = 0) -> DataFrame:
    """Allowed pages of :func:`gate` with the second at which each may be fetched, ``at``, from 0 for the first of a host, in whole milliseconds of delay."""
    extra = F.floor(F.pmod(F.xxhash64(F.lit(seed), url), F.lit(1000)) * jitter).cast("long")
    rows = pages.filter("allowed").withColumn("_wait", F.floor(F.col("delay") * 1000).cast("long") + extra)
    ranked = rank_within(global_rank(rows, ["host", order, url], "_rank"), ["host"], "_rank", "_place")
    # The first page of a host waits for nothing; the others sum up what they and those before them wait.
    waits = ranked.withColumn("_own", F.when(F.col("_place") == 1, F.lit(0)).otherwise(F.col("_wait")).cast("long"))
    total = running_total(waits, ["_rank"], "_own", "_before").withColumn("_upto", F.col("_before") + F.col("_own"))
    first = total.filter("_place = 1").select(F.col("host").alias("_host"), F.col("_before").alias("_first"))
    out = total.join(first, F.col("host") == F.col("_host"))
    return out.withColumn("at", (F.col("_upto") - F.col("_first")) / 1000).drop("_host", "_first", "_before", "_upto", "_own", "_place", "_rank", "_wait")
