"""[C2] A learnt scorer for the language classifier: character trigrams, counted and scored natively.

A language's model is the smoothed probability of a character after the two before it, from the labelled rows
of a table; a text's cost in a language is the sum of the negative logarithms.  The classifier takes the
language of less cost, a tie goes to the second.  Texts are made plain natively; their trigrams are counted and
priced in Python workers, ``WINDOW`` at a time, so no row is made for each of them: training hands on a window's
distinct trigrams, scoring a row for each text.  A model has at most as many rows as there are distinct trigrams
(a number that the alphabets bound); workers get it whole only while it has at most ``BROADCAST_ROWS``.

Defined results: texts are lower-cased, and runs of other things than letters are one blank, so figures and
signs do not speak; a null text or one without letters has cost 0 in every language; very long texts are
counted whole; rows with a null language are not learnt from; other columns are not read.  A key that comes
more than once has a row each time, with the sum over its texts; a row with a null key costs 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from weftline.functions.text import language
from weftline.scratch import Scratch

#: Weight of a character that was never seen after two others, and rows of a model that are broadcast at most.
UNSEEN, BROADCAST_ROWS = 0.1, 500_000
#: Trigrams that a worker looks at together, about, and the largest table of counts that it makes for them.
WINDOW, CELLS = 1_000_000, 1 << 22
#: Bits of a character in a trigram's number, and one past every character.
BITS, CHARS = 21, 0x110000


def plain(x: Column) -> Column:
    """Lower-case letters and single blanks, with one blank on either side."""
    return F.concat(F.lit("  "), F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def _windows(texts: pa.Array, most: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each trigram, the distinct trigrams as numbers in order, place of each trigram among them), of about ``most`` trigrams at a time.

    Texts are plain, so three characters are blanks alone; a long text is cut into pieces that overlap by two characters.
    """
    place = np.empty(CHARS, np.int64)

    def window(pieces: list[str], rows: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chars = np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole, ends = np.ones(len(chars), bool), np.cumsum(lengths)
        whole[ends - 1] = whole[ends - 2] = False
        met = np.zeros(CHARS, bool)
        met[chars] = True
        letters = np.flatnonzero(met)
        n = len(letters)
        place[letters] = np.arange(n)
        at = place[chars]
        local = ((at[:-2] * n + at[1:-1]) * n + at[2:])[whole[:-2]]
        if n**3 <= CELLS:
            used = np.bincount(local, minlength=n**3) > 0
            distinct, which = np.flatnonzero(used), (np.cumsum(used) - 1)[local]
        else:
            distinct, which = np.unique(local, return_inverse=True)
        grams = letters[distinct // (n * n)] << 2 * BITS | letters[distinct // n % n] << BITS | letters[distinct % n]
        return np.repeat(np.array(rows), lengths - 2), grams, which

    pieces, rows, held = [], [], 0
    for row, text in enumerate(texts):
        x = text.as_py()
        for i in range(0, len(x) - 2 if len(x) > 3 else 0, most):
            pieces.append(x[i : i + most + 2])
            rows.append(row)
            held += len(pieces[-1])
            if held >= most:
                yield window(pieces, rows)
                pieces, rows, held = [], [], 0
    if pieces:
        yield window(pieces, rows)


def _written(grams: np.ndarray) -> list[str]:
    """Trigrams from their numbers."""
    mask = (1 << BITS) - 1
    x = np.stack([grams >> 2 * BITS, grams >> BITS & mask, grams & mask], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return [x[i : i + 3] for i in range(0, len(x), 3)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, gram, n) of batches of (key, plain text): a window's counts."""
    for batch in batches:
        keys = batch.column(0).dictionary_encode("encode")
        of_row = keys.indices.to_numpy(zero_copy_only=False)
        for rows, grams, which in _windows(batch.column(1)):
            local = of_row[rows] * np.int64(len(grams)) + which
            if len(keys.dictionary) * len(grams) <= CELLS:
                n = np.bincount(local)
                pairs = np.flatnonzero(n)
                n = n[pairs]
            else:
                pairs, n = np.unique(local, return_counts=True)
            names = pa.array(_written(grams), pa.string())
            yield pa.RecordBatch.from_arrays([keys.dictionary.take(pa.array(pairs // len(grams))), names.take(pa.array(pairs % len(grams))), pa.array(n.astype(np.int64))], names=["key", "gram", "n"])


def trigrams(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, gram, n): trigrams of each value of a key, counted; a key may have a trigram in several rows, texts without letters have none."""
    rows = df.select(F.col(key).alias("key"), plain(F.col(text)).alias("text"))
    return rows.mapInArrow(_counted, StructType([rows.schema["key"], StructField("gram", StringType()), StructField("n", LongType())])).withColumnRenamed("key", key)


def train(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, cost) of all trigrams of all languages, with ``cost`` also for those that one lacks: gram null is any unseen one.

    The probability of c after ab is (n(abc) + UNSEEN) / (n(ab) + UNSEEN * V), V being the characters of all languages.
    """
    seen = trigrams(df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text")), "lang", "text")
    # Read five times below, each time in other columns; written, so that texts are spelt once.
    seen = Scratch(df.sparkSession, "trigrams").write(seen.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "seen")
    two = seen.groupBy("lang", F.substring("gram", 1, 2).alias("two")).agg(F.sum("n").alias("of"))
    letters = seen.select(F.substring("gram", 3, 1).alias("c")).agg(F.count_distinct("c").alias("v"))
    # Every language gets every trigram, so that a sum over a text needs one inner join.
    langs, grams = seen.select("lang").distinct(), seen.select("gram").distinct()
    every = grams.join(F.broadcast(langs.agg(F.collect_set("lang").alias("ls")))).select("gram", F.explode("ls").alias("lang")).withColumn("two", F.substring("gram", 1, 2))
    full = every.join(seen, ["lang", "gram"], "left").join(two, ["lang", "two"], "left").join(F.broadcast(letters))
    cost = -F.log((F.coalesce("n", F.lit(0)) + UNSEEN) / (F.coalesce("of", F.lit(0)) + UNSEEN * F.col("v")))
    return full.select("lang", "gram", cost.alias("cost"))


def _priced(prices: pd.DataFrame, langs: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (k, plain text) to (k, rows, a cost in each language), a row for each text; a trigram without a price costs nothing."""
    chars = np.frombuffer("".join(prices["gram"]).encode("utf-32-le"), "<u4").astype(np.int64).reshape(-1, 3)
    numbers = chars[:, 0] << 2 * BITS | chars[:, 1] << BITS | chars[:, 2]
    order = np.argsort(numbers)
    # One more, past every trigram, for those that are not found.
    numbers = np.append(numbers[order], np.iinfo(np.int64).max)
    costs = [np.append(prices[x].fillna(0.0).to_numpy(np.float64)[order], 0.0) for x in langs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.zeros(batch.num_rows) for _ in langs]
            for rows, grams, which in _windows(batch.column(1)):
                at = np.searchsorted(numbers, grams)
                at[numbers[at] != grams] = len(numbers) - 1
                for held, cost in zip(sums, costs, strict=True):
                    held += np.bincount(rows, weights=cost[at][which], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.ones(batch.num_rows, np.int64)), *map(pa.array, sums)], names=["k", "rows", *langs])

    return run


def costs(df: DataFrame, key: str, text: str, model: DataFrame, langs: list[str]) -> DataFrame:
    """(key, one column of cost per language); trigrams that no language has cost the same in all, so they are left out."""
    wide = model.filter(F.length("gram") == 3).groupBy("gram").agg(*[F.max(F.when(F.col("lang") == x, F.col("cost"))).alias(x) for x in langs])
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    if model.count() <= BROADCAST_ROWS:
        # Costs are looked up where a text is spelt, so one row a text is shuffled and not one for each of its trigrams.
        schema = StructType([texts.schema["k"], StructField("rows", LongType()), *[StructField(x, DoubleType()) for x in langs]])
        priced = texts.select("k", plain(F.col("t")).alias("t")).mapInArrow(_priced(wide.toPandas(), langs), schema)
    else:
        priced = trigrams(texts, "k", "t").join(wide, "gram").select("k", F.lit(0).cast("long").alias("rows"), *[(F.col("n") * F.col(x)).alias(x) for x in langs])
        priced = priced.unionByName(texts.select("k", F.lit(1).cast("long").alias("rows"), *[F.lit(0.0).alias(x) for x in langs]))
    # A row of its own for each row of the table, also where keys repeat: the same key has the same sum over its texts.
    sums = priced.groupBy("k").agg(F.sum("rows").alias("rows"), *[F.sum(x).alias(x) for x in langs])
    rows = sums.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return rows.select(F.col("k").alias(key), *[F.when(F.col("k").isNull(), 0.0).otherwise(F.coalesce(F.col(x), F.lit(0.0))).alias(x) for x in langs])


def classified(df: DataFrame, key: str, text: str, model: DataFrame, first: str, second: str) -> DataFrame:
    """(key, lang): the language of less cost; a tie goes to ``second``, as does a text without letters."""
    rows = costs(df, key, text, model, [first, second])
    code = language(F.col(key), F.col(first), F.col(second))
    return rows.select(key, F.when(code == "en", F.lit(first)).otherwise(F.lit(second)).alias("lang"))
