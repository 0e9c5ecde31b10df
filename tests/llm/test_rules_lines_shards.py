import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from weftline.llm import line_dedup, quality_rules, rule_ensemble, sharding, wordstats

DOC = "doc_id long, text string, source string, fail_bits string"


def brute_repeat(words, width=3):
    seen = {}
    for i in range(len(words) - width + 1):
        seen.setdefault(tuple(words[i : i + width]), []).append(i)
    return len({p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + width)})


def brute_measures(text):
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    full = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
    category = [unicodedata.category(c) for c in text]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), brute_repeat(words), len(full),
        category.count("Lu"), sum(c[0] == "L" for c in category), sum(x.rstrip()[-1:] in tuple('.!?"') for x in full), len(set(words)),
    )


def test_measures_against_brute_force():
    r = random.Random(1)
    parts = ["a", "b", "Cé", "Ⅷ", "日", "😀", "#", "$x", " ", "  ", "\n", "\t", "\x0b", "\x85", ".", "a b c ", "end.\n", "x" * 70, "x" * 71]
    texts = [None, "", " ", "\n\n", *["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(500)], "w " * 50_000]
    got = wordstats.measure(texts)
    for text, row in zip(texts, got.tolist(), strict=True):
        assert tuple(row) == brute_measures(text or ""), text
    assert wordstats.measure([]).shape == (0, 10) and (wordstats.measure(texts[::-1])[::-1] == got).all()


def test_quality_ledger_nulls_empty_clashing_names(spark):
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (3, "word " * 60, None, "x"), (3, "word " * 60, None, "x"), (4, " ".join(f"Word{i} is fine." for i in range(40)), "a", "x")]
    got = {(r.doc_id, r.n_words): r for r in quality_rules.op1(spark.createDataFrame(rows, DOC)).collect()}
    assert got[1, 0].base_failed and got[2, 0].base_failed and not got[1, 0].kept
    assert got[3, 60].n_repeat_words == 60 and got[3, 60].base_failed
    assert got[4, 120].kept and not got[4, 120].base_failed
    assert quality_rules.op1(spark.createDataFrame([], DOC)).count() == 0


def test_ablations_equal_a_second_pass(spark):
    rows = [(i, t, "a", "") for i, t in enumerate(["a b", "word " * 60, "### $$ " * 40, " ".join(f"Nice{i} words here." for i in range(50))])]
    led = quality_rules.ledger(spark.createDataFrame(rows, DOC)).cache()
    got = {(r.policy, r.without): r.kept for r in quality_rules.ablations(led).collect()}
    for version, names in quality_rules.POLICIES.items():
        for without in ("", *names):
            left = [n for n in names if n != without]
            assert got[version, without] == led.filter(quality_rules.passes(left)).count()


def test_line_dedup_is_relative_to_the_host(spark):
    rows = [(i, f"menu\nown line {i}\n\n" + ("shared\n" if i < 2 else "") + "end", "a", "") for i in range(10)]
    rows += [(100 + i, "menu\nother", "b", "") for i in range(2)] + [(200, None, "a", ""), (201, "", None, "")]
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, DOC), ratio=0.5, min_pages=3).collect()}
    assert got[0].text == "own line 0\n\nshared" and got[0]._line_dropped == 2 and got[0]._line_total == 5
    assert got[100].text == "menu\nother"  # two pages are too few to tell
    assert got[200].text is None and got[200]._line_total == 0 and got[201].text == ""
    assert line_dedup.op10(spark.createDataFrame([], DOC)).count() == 0


def test_pipeline_keeps_the_lines_of_a_group_of_copies(spark):
    import corpus_pipeline

    rows = [(i, f"menu\nown line {i}", "a", "") for i in range(20)] + [(100 + i, "menu\nbody of the copies\nits end", "a", "") for i in range(30)]
    docs = spark.createDataFrame(rows, DOC).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {i: f"own line {i}" for i in range(20)} | {100 + i: "body of the copies\nits end" for i in range(30)}
    none = spark.createDataFrame([(1, None, None, ""), (2, "x", None, "")], DOC).withColumn("n_chars", F.lit(0).cast("long"))
    assert {r.doc_id: r.text for r in corpus_pipeline.lines(spark, none, "").collect()} == {1: None, 2: "x"}


def test_url_host(spark):
    df = spark.createDataFrame([("http://www.A.example.com:80/x",), ("https://u@b.org?q",), (None,), ("nothing",)], "url string")
    assert [r[0] for r in df.select(line_dedup.url_host(F.col("url"))).collect()] == ["a.example.com", "b.org", None, ""]


def best_capacity(sizes, n):
    if n == 1:
        return sum(sizes)
    return min(max(sum(sizes[:i]), best_capacity(sizes[i:], n - 1)) for i in range(len(sizes) + 1))


def test_minimax_against_brute_force():
    r = random.Random(3)
    for _ in range(200):
        sizes, n = [r.choice([1, 2, 3, 50, 7]) for _ in range(r.randint(1, 9))], r.randint(1, 4)
        assert sharding.minimax(sizes, n)[0] == best_capacity(sizes, n)


@pytest.mark.parametrize("bin_rows", [1, 7])
def test_cut_keys_without_seeing_all_groups(spark, bin_rows):
    r = random.Random(bin_rows)
    for case in range(3):
        sizes = [r.choice([1, 5, 9, 4000 if case == 1 else 30]) for _ in range(600)]
        keys = sorted(r.sample(range(1 << sharding.KEY_BITS), len(sizes)))
        groups = spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key long, size long").repartition(3)
        got, cuts = sharding.cut_keys(groups, 8, bin_rows)
        assert got == sharding.minimax(sizes, 8)[0]
        loads = [0] * 8
        for k, s in zip(keys, sizes, strict=True):
            loads[sum(k >= c for c in cuts)] += s
        assert max(loads) == got


def test_shards_slots_and_groups(spark):
    rows = [(i, ["same", None, f"text {i}" * (i % 5)][i % 3], "a", "") for i in range(300)] + [(7, "same", "a", "")] * 2
    got = sharding.op6(spark.createDataFrame(rows, DOC)).collect()
    assert len(got) == 302 and all(r.law == "bytes" and r.grown_shard is None for r in got)
    assert len({r.shard for r in got if r["size"] == 5 and r.text_crc32 is not None and r.doc_id % 3 == 0}) == 1
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.op6(spark.createDataFrame([], DOC)).count() == 0
    assert [r["size"] for r in sharding.op6(spark.createDataFrame([(1, None, "", "")], DOC)).collect()] == [1]


def test_greatest_shard_against_brute_force(spark):
    """The query's shards hold whole groups of equal texts in one order, and none can be smaller at its greatest."""
    r = random.Random(8)
    rows = [(i if i % 9 else None, r.choice([None, "same " * 300, f"t{i % 50}" * r.randint(1, 40)]), "a", "") for i in range(700)]
    got = sharding.op6(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    key = {t: k for t, k in spark.createDataFrame(rows, DOC).select("text", sharding.order_key(F.col("text"))).distinct().collect()}
    sizes = {}
    for _, t, _, _ in rows:
        sizes[key[t]] = sizes.get(key[t], 0) + len((t or "").encode()) + 1
    loads = [sum(x["size"] for x in got if x.shard == s) for s in range(8)]
    assert max(loads) == sharding.minimax([sizes[k] for k in sorted(sizes)], 8)[0] and sum(loads) == sum(sizes.values())
    by_text = {}
    for x in got:
        by_text.setdefault((x.text_crc32, x["size"]), set()).add(x.shard)
    assert all(len(s) == 1 for s in by_text.values())
    for s in range(8):
        assert sorted(x.slot for x in got if x.shard == s) == list(range(sum(x.shard == s for x in got)))


def test_lines_at_the_ratio_repeats_and_long_lists(spark, monkeypatch):
    """At the ratio a line goes; white space stays; repeated rows count each; both ways of joining give the same."""
    rows = [(i, ("menu\n" if i < 5 else "") + f"own {i}\n\t\n \x0b" + "\nword " * 3, "a" if i % 2 else None, "") for i in range(10)] + [(0, "menu\nown 0", None, "")] * 2
    rows += [(50, "word\n" * 50_000, "b", "")]
    docs = spark.createDataFrame(rows, DOC)
    want = None
    for limit in (line_dedup.BROADCAST_BYTES, -1):
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
        got = sorted((x.doc_id, x.text, x._line_dropped) for x in line_dedup.line_dedup(docs, ratio=0.4, min_pages=2).collect())
        want = want or got
        assert got == want
    by = {d: t for d, t, _ in got}
    assert "menu" not in by[0] and "menu" not in by[1] and "\t" in by[1] and by[50].count("word") == 50_000
    assert sum(1 for d, _, _ in got if d == 0) == 3


def test_lasso_is_optimal():
    """The conditions of the optimum, from the loss alone: no slope at the intercept, slopes of the penalty's size at weights, smaller ones at none."""
    import numpy as np

    rng = np.random.default_rng(2)
    z = rng.normal(size=(400, 12))
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * z[:, 0] - z[:, 1] + 0.5)))).astype(float)
    w, b = rule_ensemble.lasso(z, y, 0.03, 3_000)
    r = 1 / (1 + np.exp(-(z @ w + b))) - y
    slope, on = z.T @ r / len(y), np.abs(w) > 1e-9
    assert abs(r.mean()) < 1e-5 and on.sum() < 12 and w[0] > 0 > w[1]
    assert np.allclose(slope[on], -0.03 * np.sign(w[on]), atol=1e-5) and (np.abs(slope[~on]) <= 0.03 + 1e-5).all()


def test_rules_are_paths_and_cover_their_rows():
    """Every rule is a path of a tree: its terms are cuts of the statistics, and deeper rules hold on fewer rows."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, len(rule_ensemble.NAMES)))
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5)).astype(float)
    model = rule_ensemble.fit(x, y)
    assert model.rules and all(1 <= len(terms) <= 6 for terms, _ in model.rules)
    p = model.score(x)
    assert ((p > 0.5) == (y > 0)).mean() > 0.95
    for terms, _ in model.rules:
        assert rule_ensemble._holds(terms, x).sum() == np.logical_and.reduce([(x[:, t.stat] > t.at) == t.above for t in terms]).sum() > 0


@pytest.mark.parametrize("n", [2, 6, 19, 20, 21])
def test_few_rows_are_learnt_from_by_the_same_rule(n):
    """No number of rows switches learning off: the score separates the two classes of a clear table of any size."""
    import numpy as np

    x = np.random.default_rng(n).normal(size=(n, len(rule_ensemble.NAMES)))
    y = (np.arange(n) % 2).astype(float)
    x[:, 0] += 10 * y
    p = rule_ensemble.fit(x, y).score(x)
    assert p[y > 0].min() > 0.5 > p[y == 0].max()


def test_rule_ensemble_on_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert rule_ensemble.op5(spark.createDataFrame([], DOC), labels).count() == 0
    rows = [(1, "a b", "", "")] * 3 + [(None, None, "", ""), (2, "w " * 300_000, "", "")]
    assert [x.score for x in rule_ensemble.op5(spark.createDataFrame(rows, DOC), labels).collect()].count(None) == 0


def test_rule_ensemble_learns_and_compiles(spark):
    r = random.Random(5)
    good = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)) + "."
    bad = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) + "###" for _ in range(80))
    rows = [(i, good() if i % 3 else bad(), "a", "") for i in range(300)] + [(1000, None, "a", ""), (1001, "", "a", "")]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(5, None, None)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in rule_ensemble.op5(docs, labels).collect()}
    assert len(got) == 302 and all(0 <= x.score <= 1 for x in got.values())
    held = [x for i, x in got.items() if x.held_out and i < 300]
    assert held and sum(x.predicted == (x.doc_id % 3 > 0) for x in held) >= 0.97 * len(held)
    model = rule_ensemble.train(docs, labels)
    sample = rule_ensemble.with_statistics(docs).select("doc_id", "_stat.*").collect()
    import numpy as np

    scores = model.score(np.array([s[1:] for s in sample], float))
    assert max(abs(got[s.doc_id].score - v) for s, v in zip(sample, scores, strict=True)) < 1e-9
    assert model.describe() and rule_ensemble.keep_good(docs, model).columns == docs.columns


def test_training_rows_are_those_of_least_id_hash_with_repeats(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{'word ' * (i + 1)}{k}", "", "") for i in range(40) for k in range(4)], DOC)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(rule_ensemble, "fit", lambda x, y: seen.append(x) or rule_ensemble.Model(0.0, [], []))
    rule_ensemble.train(docs, labels, max_train=10)
    ids = [r.i for r in labels.filter(~rule_ensemble.held_out(F.col("doc_id"))).select(F.col("doc_id").alias("i")).orderBy(F.xxhash64("i")).collect()]
    firsts = rule_ensemble.with_statistics(docs.filter(F.col("doc_id").isin(ids[:3]))).select("_stat.*").distinct().collect()
    assert len(seen[0]) == 10 and {tuple(x) for x in seen[0].tolist()} <= {tuple(map(float, x)) for x in firsts}


def test_rule_ensemble_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "", "")], DOC)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [round(x.score, 3) for x in rule_ensemble.op5(docs, none).collect()] == [0.5]
