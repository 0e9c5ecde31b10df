"""Quality classifier: a sparse rule ensemble compiled into Spark column expressions.

Boosted trees of depth three are grown on text statistics; every path from a root to a node becomes
a conjunctive rule.  Lasso logistic regression over the rules (and the clipped statistics) keeps the
few that carry weight.  The result is a list of rules with weights, which compiles to one column
expression over the statistics; scoring a corpus is one narrow pass.

The training sample is bounded by ``MAX_TRAIN`` labelled rows, those of least hash of the id, so it
does not change with the layout of the input; the fit runs on the driver over numbers only.  Ids,
labels, languages and sources are never statistics.

Defined results: a null or empty text has all statistics 0 and gets a score like any other; null
labels and labels other than 0 and 1 are not learnt from; with one class only, or without labelled
rows, the score is the share of ones (0.5 without rows); two rows of both classes are enough to learn from,
and a leaf holds five rows or more, so below ten rows there are no rules and the clipped statistics alone
carry weight; a repeated labelled id counts once per pair of rows; ties in a split go to the first statistic
and least threshold; empty tables give no rows; other columns pass through ``scored`` and ``keep_good``,
whatever their names (a column called ``out_col`` is replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import quality_rules
from weftline.llm.rows import packed

MAX_TRAIN = 20_000
CUTOFF = 0.3

#: Statistics: names and how they follow from the measurements of a text.
_m = lambda name: F.col(f"_stat.{name}").cast("double")
_share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
STATISTICS = {
    "log_words": lambda: F.log1p(_m("n_words")),
    "mean_word": lambda: _share(_m("word_chars"), _m("n_words")),
    "symbols_per_word": lambda: _share(_m("n_symbols"), _m("n_words")),
    "capitals": lambda: _share(_m("n_chars_upper"), _m("n_chars_alpha")),
    "letters": lambda: _share(_m("n_chars_alpha"), _m("word_chars")),
    "repeated_lines": lambda: _share(_m("n_dup_lines"), _m("n_lines")),
    "repeated_words": lambda: _share(_m("n_repeat_words"), _m("n_words")),
    "distinct_words": lambda: _share(_m("n_unique_words"), _m("n_words")),
    "closed_lines": lambda: _share(_m("n_end_lines"), _m("n_lines")),
    "words_per_line": lambda: _share(_m("n_words"), _m("n_lines")),
}
NAMES = tuple(STATISTICS)


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with a struct ``_stat`` of statistics, measured once per text."""

    df = df.withColumn("_stat", quality_rules.measured(F.col(text_col)))
    return df.withColumn("_stat", F.struct(*[f().alias(n) for n, f in STATISTICS.items()]))


@dataclass(frozen=True)
class Term:
    """A condition on one statistic: at most, or above, a threshold."""

    stat: int
    above: bool
    at: float


@dataclass
class Model:
    """Intercept, weighted rules and weighted clipped statistics."""

    bias: float
    rules: list[tuple[tuple[Term, ...], float]]
    linear: list[tuple[int, float, float, float]]  # statistic, low, high, weight

    def column(self) -> Column:
        """The score as an expression over ``_stat``."""
        z = F.lit(float(self.bias))
        for stat, low, high, weight in self.linear:
            z = z + F.lit(weight) * F.least(F.greatest(F.col(f"_stat.{NAMES[stat]}"), F.lit(low)), F.lit(high))
        for terms, weight in self.rules:
            holds = None
            for t in terms:
                x = F.col(f"_stat.{NAMES[t.stat]}")
                c = x > F.lit(t.at) if t.above else x <= F.lit(t.at)
                holds = c if holds is None else holds & c
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The same, in numpy, for tests."""
        z = np.full(len(x), self.bias)
        for stat, low, high, weight in self.linear:
            z += weight * np.clip(x[:, stat], low, high)
        for terms, weight in self.rules:
            z += weight * _holds(terms, x)
        return 1 / (1 + np.exp(-z))

    def describe(self) -> list[tuple[str, float]]:
        """Rules as text, heaviest first."""
        say = lambda t: f"{NAMES[t.stat]} {'>' if t.above else '<='} {t.at:.6g}"
        return sorted(((" and ".join(map(say, terms)), w) for terms, w in self.rules), key=lambda r: -abs(r[1]))


def _holds(terms: tuple[Term, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in terms:
        out &= (x[:, t.stat] > t.at) == t.above
    return out


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int, path: tuple, out: list, rows: np.ndarray, f: np.ndarray, rate: float, least: int) -> None:
    """Grow one tree on gradients ``g`` and curvatures ``h``; collect paths, add leaf values to ``f``."""
    G, H = g[rows].sum(), h[rows].sum()
    best = None
    if depth and len(rows) >= 2 * least:
        for stat, at in enumerate(cuts):
            if not len(at):
                continue
            bin_of = np.searchsorted(at, x[rows, stat], side="left")  # bin b: at[b-1] < value <= at[b]
            gs = np.cumsum(np.bincount(bin_of, g[rows], len(at) + 1))[:-1]
            hs = np.cumsum(np.bincount(bin_of, h[rows], len(at) + 1))[:-1]
            ns = np.cumsum(np.bincount(bin_of, minlength=len(at) + 1))[:-1]
            gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = -1
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0] + 1e-12):
                best = gain[k], stat, float(at[k])
    if path:
        out.append(path)
    if best is None:
        f[rows] -= rate * G / (H + 1)
        return
    _, stat, at = best
    above = x[rows, stat] > at
    for side in (False, True):
        _grow(x, g, h, cuts, depth - 1, (*path, Term(stat, side, at)), out, rows[above == side], f, rate, least)


def _simplify(terms: tuple[Term, ...]) -> tuple[Term, ...]:
    """One bound per statistic and side, in a fixed order."""
    tight: dict[tuple[int, bool], float] = {}
    for t in terms:
        key = t.stat, t.above
        tight[key] = t.at if key not in tight else (max if t.above else min)(tight[key], t.at)
    return tuple(Term(s, a, v) for (s, a), v in sorted(tight.items()))


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of logistic regression with an absolute penalty on weights, by accelerated proximal gradient."""
    start = float(np.log(y.mean() / (1 - y.mean())))
    w, v, b, vb, t = np.zeros(z.shape[1]), np.zeros(z.shape[1]), start, start, 1.0
    bound = 0.25 * np.linalg.norm(z, 2) ** 2 / len(y) + 0.25
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ v + vb))) - y
        new = v - z.T @ r / len(y) / bound
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / bound, 0)
        nb = vb - r.mean() / bound
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    return w, float(b)


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 3, rate: float = 0.2, penalty: float = 2e-3, steps: int = 600) -> Model:
    """Rules from boosted trees, weights from lasso logistic regression (accelerated proximal gradient)."""
    ones = float(y.mean()) if len(y) else 0.5
    if ones in (0.0, 1.0) or not len(y):
        return Model(float(np.log((ones + 1e-3) / (1 - ones + 1e-3))), [], [])
    cuts = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 49)))
        cuts.append((q[:-1] + q[1:]) / 2)
    f = np.full(len(y), np.log(ones / (1 - ones)))
    paths: list[tuple[Term, ...]] = []
    least = max(5, len(y) // 500)
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-f))
        _grow(x, p - y, p * (1 - p), cuts, depth, (), paths, np.arange(len(y)), f, rate, least)
    rules = sorted({_simplify(p) for p in paths}, key=lambda r: [(t.stat, t.above, t.at) for t in r])
    marks: dict[bytes, tuple] = {}
    for r in rules:  # rules that hold on the same rows are one rule: the shortest
        key = np.packbits(_holds(r, x)).tobytes()
        if key not in marks or len(r) < len(marks[key]):
            marks[key] = r
    rules = list(marks.values())
    low, high = np.quantile(x, 0.02, axis=0), np.quantile(x, 0.98, axis=0)
    lin = np.clip(x, low, high)
    design = np.column_stack([*[_holds(r, x).astype(float) for r in rules], lin]) if rules else lin
    mean, scale = design.mean(0), design.std(0)
    # Rules that hold nearly always or never get no boost from tiny scales; linear terms weigh 0.4, as one rule.
    scale = np.where(scale < 0.02, 1.0, scale)
    scale[len(rules) :] /= 0.4
    z = (design - mean) / scale
    w, b = lasso(z, y, penalty, steps)
    w = w / scale
    bias = b - float(w @ mean)
    n = len(rules)
    kept = [(rules[i], float(w[i])) for i in range(n) if abs(w[i]) > 1e-9]
    linear = [(j, float(low[j]), float(high[j]), float(w[n + j])) for j in range(x.shape[1]) if abs(w[n + j]) > 1e-9]
    return Model(bias, kept, linear)


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> Model:
    """Fit on the ``max_train`` labelled rows of least id hash outside the held-out fold; ids repeated in ``docs`` count as rows."""
    sample = (
        labels.select(F.col("doc_id").alias("_lid"), F.col("quality").alias("_label"))
        .filter(F.col("_label").isin(0, 1) & ~held_out(F.col("_lid")))
        .orderBy(F.xxhash64("_lid"), "_lid", "_label").limit(max_train)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), F.col("_id") == F.col("_lid"))
    got = with_statistics(rows.select("_id", "_label", "_text"), "_text").select("_id", "_label", "_stat.*")
    got = sorted(map(tuple, got.orderBy(F.xxhash64("_id"), *got.columns).limit(max_train).collect()))
    x = np.array([r[2:] for r in got], float).reshape(len(got), len(NAMES))
    return fit(x, np.array([r[1] for r in got], float))


def scored(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score in ``out_col``."""
    rows = with_statistics(packed(docs, text=F.col(text_col))).select("row", model.column().alias("score"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != out_col], F.col("score").alias(out_col))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that score at least ``cutoff``."""
    rows = with_statistics(packed(docs, text=F.col(text_col))).select("row", model.column().alias("score"))
    return rows.filter(F.col("score") >= cutoff).select("row.*")


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    )
