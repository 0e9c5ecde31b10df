"""Work that must not grow faster than the input: tasks, batches, folders and shuffles."""

from pyspark.sql import functions as F


def test_many_files_make_few_partitions(spark, tmp_path):
    from weftline.plans.archive import _docx
    from weftline.sources import formats

    for i in range(300):
        (tmp_path / f"d{i:03d}.docx").write_bytes(_docx(f"w{i}"))
    formats.register(spark)
    rows = spark.read.format("weft-docx").load(str(tmp_path)).filter(F.col("part").isin("body", "footnote"))
    assert rows.rdd.getNumPartitions() <= 2 * formats.PARTITIONS
    got = {(r.path.rpartition("/")[2], r.para_idx, r.part) for r in rows.select("path", "para_idx", "part").collect()}
    assert got == {(f"d{i:03d}.docx", k, p) for i in range(300) for k, p in ((0, "body"), (1, "body"), (12, "footnote"))}


def test_batches_do_not_grow_with_the_rows(spark):
    import os

    from weftline.plans import archive

    rows = spark.range(4_000).withColumnRenamed("id", "event_id")
    run = archive.interrupted(spark, rows, ["event_id"], "growth", lambda b: b, every=10)
    assert sorted(r.event_id for r in run.rows("event_id long").collect()) == list(range(4_000))
    assert len(os.listdir(f"{run.root.removeprefix('file://')}/counts")) <= 2 * archive.BATCHES + 4


def test_rare_pieces_make_no_states():
    from weftline.llm import bpe

    ranks = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate([b"ab", b"bc", b"abc", b"cd", b"abcd", b"da"])}
    fst = bpe.Transducer(ranks)
    pieces = [b"xabcda", b"abcdab", b"dabcbc", b"bcdabcd", b"cdcda"]
    for visit in range(4):  # walked first, then by states
        got = [fst.encode(p) for p in pieces]
        assert got == [[ranks[t] for t in bpe.merge(p, ranks)] for p in pieces]
        assert (len(fst._states) == 1) == (visit == 0)


def test_costs_shuffle_no_trigrams(spark):
    from weftline.functions import charmodel

    df = spark.createDataFrame([(1, "en", "the cat the"), (2, "de", "der hund der"), (3, "en", None)], "id long, lang string, text string")
    rows = charmodel.costs(df, "id", "text", charmodel.train(df, "text", "lang"), ["en", "de"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "hashpartitioning(k#" in plan and not any("gram" in x and "k#" in x for x in plan.split("\n") if "Exchange hashpartitioning" in x)
    got = {r.id: (r.en, r.de) for r in rows.collect()}
    assert got[1][0] < got[1][1] and got[2][1] < got[2][0] and got[3] == (0.0, 0.0)


def test_scan_by_words():
    from weftline.functions import translit

    assert translit.scanned_iast("Dharma kṣetre\n12 k") == "धर्म क्षेत्रे\n१२ क्"
    assert translit.scanned_itrans("kAUM k.h OM") == "क्ॐ क्" + translit.VIRAMA + " ॐ"
    assert translit._IAST.kept.cache_info().currsize <= translit.KEPT_WORDS


def test_pieces_that_come_once_make_no_states():
    import gc

    from weftline.llm import bpe

    ranks = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate([b"ab", b"bc", b"abc", b"cd", b"abcd", b"da"])}
    fst = bpe.Transducer(ranks)
    for p in (b"abcdab", b"abcdb", b"abab", b"abdacd", b"aabcdabc"):  # equal beginnings
        assert fst.encode(p) == [ranks[t] for t in bpe.merge(p, ranks)]
    assert len(fst._states) == 1
    bpe.tokenizer(b"\n".join(bpe.base64.b64encode(t) + b" %d" % r for t, r in ranks.items()), "[a-z]+")
    assert gc.get_freeze_count() > 0


def test_excerpts_look_at_no_more_than_they_show(spark):
    from weftline.functions import text

    df = spark.createDataFrame([("a😀b😀c" * 50,), ("😀" * 3,), ("a😀😀",), ("ab",), ("",), (None,), ("é" * 9 + "😀",)], "x string")
    shown = df.select(text.truncate_units(F.col("x"), 5).alias("y"))
    assert [r.y for r in shown.collect()] == ["a😀b…", "😀😀…", "a😀😀", "ab", "", None, "é" * 5 + "…"]
    plan = shown._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "regexp_replace(" not in plan


def test_a_memo_moves_results_once(spark, tmp_path):
    from weftline.streaming import incremental

    memo = incremental.Memo(spark, str(tmp_path / "memo"))
    df = spark.range(500).select(F.concat(F.lit("text "), "id").alias("x"))
    assert [memo.convert(df.filter(f), "x", F.upper, "y", run=k)[1] for k, f in ((1, "x < 'text 3'"), (2, "true"))] == [223, 277]
    assert not [p for p in (tmp_path / "memo").iterdir() if p.is_dir()]  # no second deal by folder
    got = memo.convert(df, "x", F.upper, "y", run=3)[0].groupBy("y_run").count().collect()
    assert {r.y_run: r["count"] for r in got} == {1: 223, 2: 277}


def test_chapters_lie_in_one_folder(spark, tmp_path):
    from weftline.sources import files

    names = ["a/b", "x y+%2F", "k=1,j=2", "अ", None]
    df = spark.createDataFrame([(n, i, f"t{i}") for n in names for i in (1, 0)] + [("again", 0, "z\n")], "j string, i int, t string").withColumn("k", F.lit(7))
    for _ in range(2):  # the second run replaces the first one's files
        files.write_chapters(df, ["j", "k"], "i", "t", f"file://{tmp_path}/out")
        assert len(list((tmp_path / "out").iterdir())) == 6 and all(p.is_file() for p in (tmp_path / "out").iterdir())
        got = {(r.j, r.k, r.body) for r in files.read_chapters(spark, f"file://{tmp_path}/out", ["j", "k"]).collect()}
        assert got == {(n, "7", "t0\n\nt1") for n in names} | {("again", "7", "z\n")}


def test_ranks_shuffle_rows_once(spark):
    from weftline.operators import ordered

    df = spark.createDataFrame([(k, None if k % 7 == 0 else f"n{k % 5}") for k in range(200)], "k long, s string")
    rows = ordered.global_rank(df.repartition(8), ["s", F.col("k") * -1], "rank")
    assert "_o0" not in rows._jdf.queryExecution().optimizedPlan().toString() and rows.columns == ["k", "s", "rank"]
    want = sorted(range(200), key=lambda k: ("" if k % 7 == 0 else f"n{k % 5}", -k))
    assert [r.k for r in sorted(rows.collect(), key=lambda r: r.rank)] == want and sorted(r.rank for r in rows.collect()) == list(range(1, 201))


def _counted(spark, df, column):
    """``df``, and an accumulator of how often its column was made."""
    seen = spark.sparkContext.accumulator(0)

    def mark(x):
        seen.add(1)
        return x

    return df.withColumn(column, F.udf(mark, df.schema[column].dataType)(column)), seen


def test_a_layout_makes_its_nodes_once(spark):
    from weftline.operators import graph

    nodes, seen = _counted(spark, spark.createDataFrame([("b", 2), ("a", 1), ("b", 1)], "g string, k int"), "g")
    got = {(r.g, r.k, r.y) for r in graph.layout(nodes, ["g"], ["k"], 10, 5, 3).collect()}
    assert got == {("a", 1, 10), ("b", 1, 18), ("b", 2, 23)} and seen.value == 3


def test_missing_content_makes_bare_texts_once(spark):
    from weftline.operators import align

    lines = [(1, i, c * 70) for i, c in enumerate("कखगघङच")]
    paragraphs, seen = _counted(spark, spark.createDataFrame(lines, "d long, i int, t string"), "t")
    sections = spark.createDataFrame([(1, 1, "क" * 70, ["ख" * 70, "ग" * 70]), (1, 2, "घ" * 70, [])], "d long, n long, root string, notes array<string>")
    got = align.missing_content(paragraphs, sections, "d", "i", "t", "n", "root", "notes", "x").collect()
    assert [(r.d, r.n, r.start, r.source_length, r.target_length) for r in got] == [(1, 2, 3, 210, 70)] and seen.value <= 2 * len(lines)


def test_summaries_hand_on_what_may_be_heavy():
    import numpy as np
    import pandas as pd
    from weftline.llm import minhash_dedup, shingles

    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 60))) + (" one two three four five" if i % 50 == 0 else "") for i in range(1_000)]
    rows = pd.concat(list(minhash_dedup._summaries("text", minhash_dedup.COUNTERS, minhash_dedup.HEAVY)(iter([pd.DataFrame({"text": texts})]))))
    heavy = shingles.shingles(["one two three four five"], minhash_dedup.WIDTH)[0][0].view(np.int64)[0]
    lost = int(rows[rows.h.isna()].n.iloc[0])
    assert len(rows) == 2 and lost <= minhash_dedup.HEAVY * len(texts) / 2
    assert 20 - lost <= rows[rows.h == heavy].n.iloc[0] <= 20


def test_trigrams_are_counted_where_they_are_spelt(spark):
    from collections import Counter

    import pyarrow as pa
    from weftline.functions import charmodel

    texts = ["  the cat the ", "   ", "  a ", "  " + "der 𐐨hund " * 30, "  अकारः " * 2]
    want = Counter((i, x[j : j + 3]) for i, x in enumerate(texts) if len(x) > 3 for j in range(len(x) - 2))
    for most in (1, 7, 10_000):  # windows that cut texts, and one of all
        got = Counter()
        for rows, grams, which in charmodel._windows(pa.array(texts), most):
            names = charmodel._written(grams)
            assert names == sorted(set(names))
            got.update(zip(rows.tolist(), [names[i] for i in which], strict=True))
        assert got == want
    df = spark.createDataFrame([("en", "The cat, the"), ("en", None), ("de", "der")], "lang string, text string")
    rows = charmodel.trigrams(df, "lang", "text")
    assert "explode(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert Counter({(r.lang, r.gram): r.n for r in rows.collect()}) == Counter((k, x[i : i + 3]) for k, x in (("en", "  the cat the "), ("de", "  der ")) for i in range(len(x) - 2))


def test_costs_are_equal_on_both_ways(spark, monkeypatch):
    from weftline.functions import charmodel

    rows = [(1, "en", "the cat the"), (2, "de", "der hund der"), (2, "de", "die"), (3, "en", None), (None, "en", "the"), (4, "fr", "ж 漢字")]
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    model = charmodel.train(df.filter("lang <> 'fr'"), "text", "lang").cache()
    ways = []
    for most in (charmodel.BROADCAST_ROWS, 0):
        monkeypatch.setattr(charmodel, "BROADCAST_ROWS", most)
        ways.append(sorted((str(r.id), round(r.en, 9), round(r.de, 9), round(r.none, 9)) for r in charmodel.costs(df, "id", "text", model, ["en", "de", "none"]).collect()))
    assert ways[0] == ways[1] and [r[0] for r in ways[0]] == ["1", "2", "2", "3", "4", "None"]  # a key that comes twice has two rows
    assert all(r[1:] == (0, 0, 0) for r in ways[0] if r[0] in ("3", "4", "None")) and all(r[3] == 0 for r in ways[0])
    model.unpersist()
