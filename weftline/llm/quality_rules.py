"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the measurements and one integer whose
bit ``i`` says that rule ``i`` failed.  Policies are versioned sets of rules, that is masks: applying
a policy is ``fail_bits & mask = 0``, and an ablation (what would policy P keep without rule r?) is a
bitwise aggregation of the stored bits, never a second pass over texts.

Defined results: a null or empty text has zero words and fails ``too_few_words`` only among the
rules that need words; ties cannot occur (each row is judged alone); repeated rows are judged alike;
an empty table gives an empty ledger; very long texts are measured whole, one at a time; columns of the input other than ``id_col`` and ``text_col`` are
not read, so clashing names in it do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import wordstats as W
from weftline.llm.workers import text_udf

MEASURES = ", ".join(f"{name} long" for name in W.MEASURES)


def measured(text: Column) -> Column:
    """A struct of ``MEASURES`` of each whole text."""
    return text_udf(MEASURES)(lambda texts: pd.DataFrame(W.measure(texts), columns=list(W.MEASURES)))(text)


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` is true; ``fails`` reads measurement columns only."""

    bit: int
    name: str
    fails: Callable[[], Column]


c = F.col
#: Bit numbers are never reused; a changed threshold is a new rule with a new bit.
RULES = (
    Rule(0, "too_few_words", lambda: c("n_words") < 50),
    Rule(1, "repeated_windows", lambda: 100 * c("n_repeat_words") > 50 * c("n_words")),
    Rule(2, "short_mean_word", lambda: c("word_chars") < 2 * c("n_words")),
    Rule(3, "long_mean_word", lambda: c("word_chars") > 14 * c("n_words")),
    Rule(4, "many_symbols", lambda: 10 * c("n_symbols") > c("n_words")),
    Rule(5, "repeated_lines", lambda: 10 * c("n_dup_lines") > 3 * c("n_lines")),
    Rule(6, "mostly_capitals", lambda: 2 * c("n_chars_upper") > c("n_chars_alpha")),
    Rule(7, "few_letters", lambda: 10 * c("n_chars_alpha") < 6 * c("word_chars")),
)
#: Versioned policies: names of rules.  ``base`` is the first version, ``v1`` adds the rest.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": tuple(r.name for r in RULES),
}


def mask(names: Iterable[str], rules: Iterable[Rule] = RULES) -> int:
    """The bitmask of a policy."""
    bits = {r.name: 1 << r.bit for r in rules}
    out = 0
    for name in names:
        out |= bits[name]
    return out


def fail_bits(rules: Iterable[Rule] = RULES) -> Column:
    """One bigint with the bit of every failed rule."""
    out = F.lit(0).cast("long")
    for r in rules:
        out = out.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Iterable[Rule] = RULES) -> DataFrame:
    """id, measurements and ``fail_bits``: one row per input row, in one narrow pass."""

    out = df.select(F.col(id_col).alias("doc_id"), measured(F.col(text_col)).alias("m")).select("doc_id", "m.*")
    return out.withColumn("fail_bits", fail_bits(rules))


def passes(policy: Iterable[str], bits: str | Column = "fail_bits", rules: Iterable[Rule] = RULES) -> Column:
    """True where no rule of the policy failed."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def cases(policies: dict[str, tuple[str, ...]] = POLICIES, rules: Iterable[Rule] = RULES) -> list[tuple[str, str, int]]:
    """(policy, rule left out or "", mask): each policy whole, and without each of its rules."""
    out = []
    for version, names in policies.items():
        out += [(version, without, mask([x for x in names if x != without], rules)) for without in ("", *names)]
    return out


def ablations(led: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES, rules: Iterable[Rule] = RULES) -> DataFrame:
    """For each policy, and each policy without one of its rules: documents kept, of how many.

    The ledger is first reduced to counts per distinct ``fail_bits`` (at most 2^rules rows whatever
    the corpus), then every mask is tested against those counts.
    """
    bits = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    tested = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(w).alias("without"), F.lit(m).cast("long").alias("mask")) for p, w, m in cases(policies, rules)])
    kept = F.when(F.col("fail_bits").bitwiseAND(F.col("mask")) == 0, F.col("n")).otherwise(0)
    return bits.select("*", F.inline(tested)).groupBy("policy", "without").agg(F.sum(kept).alias("kept"), F.sum("n").alias("total"))


def rule_counts(led: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Failures per rule plus the or / and of all bits: one row."""
    return led.agg(
        F.bit_or("fail_bits").alias("any_failed"),
        F.bit_and("fail_bits").alias("all_failed"),
        *[F.sum(F.col("fail_bits").bitwiseAND(1 << r.bit).cast("boolean").cast("long")).alias(r.name) for r in rules],
    )


def op1(df: DataFrame) -> DataFrame:
    """The contract's columns: base rules and the verdict of policy ``v1``."""
    led = ledger(df)
    base = ~passes(POLICIES["base"])
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & passes(POLICIES["v1"])).alias("kept"), "fail_bits",
    )


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM t),
l AS (SELECT *, list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS wl FROM w),
tri AS (SELECT rid, i, list_slice(ws, i, i + 2) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM l WHERE len(ws) >= 3)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY rid),
m AS (SELECT l.rid, doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(wl) - len(list_distinct(wl)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(wl)::BIGINT AS n_lines,
  len(regexp_extract_all(text, '\p{Lu}'))::BIGINT AS up, len(regexp_extract_all(text, '\p{L}'))::BIGINT AS al
  FROM l LEFT JOIN rep ON l.rid = rep.rid),
b AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (word_chars < 2 * n_words)::INT
  + 8 * (word_chars > 14 * n_words)::INT + 16 * (10 * n_symbols > n_words)::INT + 32 * (10 * n_dup_lines > 3 * n_lines)::INT
  + 64 * (2 * up > al)::INT + 128 * (10 * al < 6 * word_chars)::INT)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""

_CASES = ", ".join(f"('{p}', '{w}', {m})" for p, w, m in cases())
ABLATIONS = f"""WITH led AS ({ORACLE}) SELECT policy, without, (count(*) FILTER (fail_bits & mask = 0))::BIGINT AS kept, count(*)::BIGINT AS total
FROM led, (VALUES {_CASES}) c(policy, without, mask) GROUP BY policy, without"""
