import collections
import itertools
import os
import random

import numpy as np
import pytest

import corpus_pipeline
import weftline.components
from weftline.components import components
from weftline.llm import bpe, decontaminate, minhash_dedup, shingles
from weftline.scratch import Scratch

DOC = "doc_id long, text string, lang string, source string, n_chars long"
NONE = np.zeros(0, np.uint64), np.zeros(0)


def text(r, n=120):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def edited(r, t, k):
    words = t.split()
    for _ in range(k):
        words[r.randrange(len(words))] = "edit" + str(r.random())[2:8]
    return " ".join(words)


def classes_by_force(rows, heavy=NONE):
    """Least id of each class, by comparing all pairs."""
    sets = [minhash_dedup.weighted(d, heavy) for d in shingles.shingles([t for _, t in rows])]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        same = rows[i][1] is not None and rows[i][1] == rows[j][1]
        if same or rows[i][0] == rows[j][0] or minhash_dedup.jaccard(sets[i], sets[j]) >= 0.8:
            parent[find(i)] = find(j)
    least = collections.defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOC)


def corpus(seed, size=60):
    r = random.Random(seed)
    rows = [(i, text(r)) for i in range(size)]
    centre = text(r, 150)
    rows += [(1000 + i, edited(r, centre, 3 + i % 4)) for i in range(90)] + [(5000, centre)]  # a ring of copies: most pairs of them are no links
    rows += [(2000 + i, rows[3][1]) for i in range(5)] + [(2100 + i, edited(r, rows[4][1], 1)) for i in range(3)]
    passage = text(r, 40)
    rows += [(3000 + i, passage + " " + text(r, 60)) for i in range(30)]
    rows += [(4000, None), (4001, None), (4002, ""), (4003, ""), (4004, "one two"), (4005, "one two"), (4006, "one three"), (4007, "a b c d e"), (4008, "long " + text(r, 3000))]
    r.shuffle(rows)
    return rows


def test_shingles_equal_sets_of_words():
    r = random.Random(1)
    for t in ["", None, "a", "a b", "a b c d e", "x" * 500 + " y", "é ü\t\nß", *[" ".join(r.choice("abc") for _ in range(r.randint(0, 30))) for _ in range(200)]]:
        words = (t or "").split()
        grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else collections.Counter([tuple(words)] if words else [])
        h, n = shingles.shingles(["other text here to shift", t, "more"])[1]
        assert sorted(n.tolist()) == sorted(grams.values()), t


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    error = []
    for _ in range(200):
        u = np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64))
        w = rng.choice([1, 1, 2, 0.5, 0.7], 300)
        keep = rng.random(300) < 0.85
        a, b = (u, w), (u[keep], np.where(rng.random(300) < 0.2, w * rng.choice([1, 2, 0.5], 300), w)[keep])
        error.append((minhash_dedup.signature(*a) == minhash_dedup.signature(*b)).mean() - minhash_dedup.jaccard(a, b))
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.06


def test_samples_of_very_long_weighted_texts():
    """Estimates hold far beyond any table of draws: independent variables per shingle and sample."""
    rng = np.random.default_rng(3)
    u = np.sort(rng.integers(0, 1 << 63, 500_000).astype(np.uint64))
    w = rng.choice([0.5, 0.7, 2.0, 3.0], len(u))
    keep = rng.random(len(u)) < 0.8
    a, b = (u, w), (u[keep], w[keep])
    c = u, np.where(rng.random(len(u)) < 0.3, w * 2, w)
    for x, y in ((a, b), (a, c)):
        assert abs((minhash_dedup.signature(*x) == minhash_dedup.signature(*y)).mean() - minhash_dedup.jaccard(x, y)) < 4 * 0.042


def test_least_hashes_give_their_shingles_back():
    h = np.random.default_rng(8).integers(0, 1 << 64, 5_000, np.uint64)
    x = h[:, None] * minhash_dedup._A + minhash_dedup._B
    assert np.array_equal((x.min(0) - minhash_dedup._B) * minhash_dedup._BACK, h[x.argmin(0)])
    assert np.array_equal(minhash_dedup.signature(h, np.ones(len(h))), minhash_dedup.mix(h[x.argmin(0)] ^ minhash_dedup._B))


def test_equal_weights_need_no_logarithm():
    """A weight of one takes the short way; it gives the sample that the full formula gives."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        u = np.sort(rng.integers(0, 1 << 63, 40).astype(np.uint64))
        assert (minhash_dedup.signature(u, np.ones(40)) == minhash_dedup.signature(u, np.full(40, 1 + 1e-15))).all()


def test_exact_similarities_by_postings():
    rng = np.random.default_rng(5)
    docs = []
    for _ in range(30):
        h = np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64))
        docs.append((h, rng.choice([0.5, 1.0, 2.0], len(h))))
    postings = minhash_dedup.Postings(docs)
    for x in docs:
        assert np.allclose(postings.similarities(x), [minhash_dedup.jaccard(x, y) for y in docs])
    assert len(minhash_dedup.Postings([]).similarities(docs[0])) == 0


def test_hot_bucket_of_unlike_texts_ends_soon(spark, monkeypatch):
    """Thirty texts that share one band and are otherwise unlike: a round per member once."""
    monkeypatch.setattr(minhash_dedup, "BUCKET", 6)
    r = np.random.default_rng(6)
    rows = [(i, [7, *r.integers(1 << 20, 1 << 60, 23).tolist()], r.bytes(96), 10) for i in range(30)]
    run = object.__new__(minhash_dedup._Run)
    run.spark, run.scratch = spark, Scratch(spark, "test")
    run.nodes = spark.createDataFrame(rows, "node long, bands array<long>, sketch binary, n_chars long")
    run.sketches = run.nodes.select("node", "sketch", "n_chars")
    names = []
    write = run.scratch.write
    run.scratch.write = lambda df, name: names.append(name) or write(df, name)
    edges, _ = run.coarse_edges()
    assert edges.count() == 0 and names.count("live") <= 3


@pytest.mark.parametrize("hot", [1_000, 3])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(weftline.components, "HOT", hot)
    r = random.Random(5)
    edges = [(r.randint(0, 200), r.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1030)] + [(2000, 2000)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test")).collect()}
    assert got == {x: find(x) for x in parent}


@pytest.mark.parametrize("hot", [1_000, 3])
def test_components_of_more_nodes_than_are_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(weftline.components, "BROADCAST_NODES", 0)
    test_components(spark, monkeypatch, hot)


def written(spark) -> tuple[Scratch, list[str]]:
    """A folder for intermediate tables, and the names of those that are written there."""
    scratch, names = Scratch(spark, "test"), []
    write = scratch.write
    scratch.write = lambda df, name: names.append(name) or write(df, name)
    return scratch, names


def test_stars_need_no_round(spark):
    scratch, names = written(spark)
    edges = [(0, x) for x in range(1, 50)] + [(x, 100) for x in range(101, 120)] * 2 + [(200, 200)]
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()}
    assert got == {x: 0 for x in range(50)} | {x: 100 for x in range(100, 120)} | {200: 200}
    assert names == ["edges", "least"]


@pytest.mark.parametrize("most", [300_000, 0])
def test_a_star_around_any_node_needs_one_round(spark, monkeypatch, most):
    monkeypatch.setattr(weftline.components, "BROADCAST_NODES", most)
    scratch, names = written(spark)
    edges = [(50, x) for x in range(100) if x != 50] + [(299, x) for x in range(200, 299)]
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()}
    assert got == {x: x // 100 * 100 if x < 100 else 200 for x in [*range(100), *range(200, 300)]}
    assert names.count("least") == 2


def test_large_cluster_needs_components_once_for_its_links(spark, monkeypatch):
    """Members are joined by way of the centres without a search for components; only links of the rest need one."""
    for name, value in {"CLUSTER": 8, "BLOCK": 7}.items():
        monkeypatch.setattr(minhash_dedup, name, value)
    calls, search = [], minhash_dedup.components
    monkeypatch.setattr(minhash_dedup, "components", lambda *a: calls.append(1) or search(*a))
    rows = corpus(11)
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == classes_by_force(rows, minhash_dedup.heavy_shingles(frame(spark, rows), "text"))
    assert len(calls) == 2


def test_centres_that_share_members_are_one():
    assert minhash_dedup._joined.func([[1, 5], [3], [5, 9], []]) == {1: 1, 5: 1, 9: 1, 3: 3}


@pytest.mark.parametrize("limits", [{}, {"BUCKET": 6, "CLUSTER": 8, "BLOCK": 7, "BROADCAST_IDS": 3}])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, limits):
    """With tiny limits the ways for hot buckets and for large clusters are exercised too."""
    for name, value in limits.items():
        monkeypatch.setattr(minhash_dedup, name, value)
    rows = corpus(11)
    heavy = minhash_dedup.heavy_shingles(frame(spark, rows), "text")
    assert len(heavy[0])
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(frame(spark, rows).repartition(3)).collect()}
    assert got == classes_by_force(rows, heavy)


def test_groups_are_kept_whole_over_batches():
    import pandas as pd

    frame = pd.DataFrame({"k": [1, 1, 2, 3, 3, 3, 3, 4, 5, 5], "v": range(10)})
    for size in range(1, 11):
        parts = list(minhash_dedup._grouped((frame.iloc[i : i + size] for i in range(0, 10, size)), "k"))
        assert pd.concat(parts)["v"].tolist() == list(range(10))
        assert sum(p["k"].nunique() for p in parts) == 5


def test_heavy_shingles_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "COUNTERS", 50)  # summaries lose much; the second scan still counts exactly
    rows = corpus(12)
    df = collections.Counter(h for d in shingles.shingles([t for _, t in rows]) for h in d[0].tolist())
    n = sum(t is not None for _, t in rows)
    keys, weights = minhash_dedup.heavy_shingles(frame(spark, rows).repartition(4), "text")
    floor = 0.01 * n
    assert set(keys.tolist()) == {h for h, c in df.items() if c >= floor} and ((weights >= 0.5) & (weights <= 1)).all()


def test_keep_one_and_repeated_rows(spark):
    r = random.Random(2)
    a = text(r)
    rows = [(3, a), (1, a), (1, a), (2, text(r)), (4, None), (None, None), (None, a)]
    out = minhash_dedup.keep_one(frame(spark, rows))
    assert sorted(((x.doc_id, x.text) for x in out.collect()), key=str) == sorted([(1, a), (2, rows[3][1]), (4, None), (None, None), (None, a)], key=str)
    assert minhash_dedup.op3(frame(spark, [])).count() == 0


def test_keep_one_of_ids_with_several_texts_and_clashing_names(spark):
    r = random.Random(3)
    a, b = text(r), text(r)
    rows = [(5, a, "y", 2), (5, a, "x", 1), (5, b, "x", 1), (7, b, "x", 1), (8, edited(r, a, 1), "x", 1), (9, None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, cluster long")
    got = sorted(((x.doc_id, x.text, x.node, x.cluster) for x in minhash_dedup.keep_one(docs).collect()), key=str)
    assert got == sorted([(5, a, "x", 1), (5, b, "x", 1), (9, None, "x", 1)], key=str)
    assert {x.doc_id: x.class_id for x in minhash_dedup.op3(docs).collect()} == {5: 5, 7: 5, 8: 5, 9: 9}


def test_very_long_texts_are_hashed_whole(spark):
    r = random.Random(4)
    words = [r.choice("abcdefgh") + str(r.randrange(10_000)) for _ in range(300_000)]
    other = words[:250_000] + [w + "x" for w in words[250_000:]]
    unlike = words[:150_000] + [w + "y" for w in words[150_000:]]
    got = {x.doc_id: x.class_id for x in minhash_dedup.op3(frame(spark, [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(unlike))])).collect()}
    assert got == {1: 1, 2: 1 if jaccard_of(words, other) >= 0.8 else 2, 3: 3}


def jaccard_of(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


SF = "/root/testdata/sf0.01/documents.parquet"


@pytest.mark.skipif(not os.path.exists(SF), reason="the driver's tables are not here")
def test_recall_against_all_pairs_on_documents(spark):
    """Every pair of the table's texts that is a link, by an inverted index over all of them, is in one class, and classes have no more."""
    docs = spark.read.parquet(SF)
    rows = [(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()]
    heavy = minhash_dedup.heavy_shingles(docs, "text")
    sets = [minhash_dedup.weighted(d, heavy) for d in shingles.shingles([t for _, t in rows])]
    postings = minhash_dedup.Postings(sets)
    got = {x.doc_id: x.class_id for x in minhash_dedup.near_duplicates(docs).collect()}
    links = [(rows[i][0], rows[j][0]) for i, s in enumerate(sets) if len(s[0]) for j in np.flatnonzero(postings.similarities(s) >= 0.8 - 1e-9).tolist() if i < j]
    recall = sum(got[a] == got[b] for a, b in links) / len(links)
    assert len(links) > 50 and recall >= 0.99
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    wrong = [d for d, t in rows if t and t.split() and got[d] != find(d)]
    assert len(wrong) <= 0.001 * len(rows)


@pytest.mark.skipif(not os.path.exists(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("law", ["share", "usual"])
def test_bands_find_the_links_of_either_idf(spark, law):
    """The signatures' recall against all links that a law itself makes: that of the operator and the usual ln((1 + n) / (1 + df)) + 1."""
    docs = shingles.shingles([x.text for x in spark.read.parquet(SF.replace("sf0.01", "sf0.1")).select("text").distinct().collect()])
    df = collections.Counter(h for d in docs for h in d[0].tolist())
    n = len(docs)
    of = (lambda c: minhash_dedup.idf(c / n)) if law == "share" else (lambda c: np.log((1 + n) / (1 + c)) + 1)
    sets = [(h, tf * of(np.array([df[x] for x in h.tolist()], float))) for h, tf in docs]
    postings = minhash_dedup.Postings(sets)
    links = [(i, j) for i, s in enumerate(sets) if len(s[0]) for j in np.flatnonzero(postings.similarities(s) >= 0.8 - 1e-9).tolist() if i < j]
    # Links are few in this table; all of them count.
    bands = {i: minhash_dedup.band_values(minhash_dedup.signature(*sets[i])) for i in {x for pair in links for x in pair}}
    assert len(links) > 10 and sum((bands[i] == bands[j]).any() for i, j in links) >= 0.9 * len(links)


def test_idf_depends_on_the_share_alone():
    share = np.array([0.001, 0.01, 0.1, 0.5, 1.0])
    assert np.allclose(minhash_dedup.idf(share), [1, 1, 0.75, 1 - 0.5 * np.log(50) / np.log(100), 0.5])


def leaks_by_force(docs, items, t=0.8):
    out = set()
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    for d, x in docs:
        for i, y in items:
            w = (y or "").split()
            n = min(5, len(w))
            if w and len(grams(w, n) & grams((x or "").split(), n)) >= t * len(grams(w, n)) - 1e-9:
                out.add((d, i))
    return out


@pytest.mark.parametrize("inline", [50_000, 0])
def test_leaks_against_all_pairs(spark, monkeypatch, inline):
    monkeypatch.setattr(decontaminate, "MAX_INLINE", inline)
    r = random.Random(4)
    items = [(i, text(r, r.choice([1, 2, 3, 4, 5, 6, 8, 14, 30, 60]))) for i in range(40)] + [(90, None), (91, ""), (92, "same words"), (93, "same words")]
    docs = []
    for i in range(120):
        parts = [text(r, r.choice([3, 50, 400]))]
        for _ in range(i % 3):
            item = r.choice(items)[1] or ""
            parts.append(edited(r, item, r.choice([0, 0, 1, 2])) if item else "")
        parts.append(text(r, 5))
        docs.append((i, " ".join(parts)))
    docs += [(500, None), (501, ""), (502, items[0][1]), (502, items[0][1]), (503, "some same words here")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = [(x.doc_id, x.item_id) for x in decontaminate.leaks(frame(spark, docs), bench).collect()]
    want = leaks_by_force(docs, items)
    assert set(got) == want and len(want) > 20 and len(got) == len(want) + len({i for d, i in want if d == 502})
    kept = [x.doc_id for x in decontaminate.decontaminate(frame(spark, docs), bench).collect()]
    assert sorted(kept) == sorted(d for d, _ in docs if d not in {x for x, _ in want})
    assert decontaminate.leaks(frame(spark, []), bench).count() == 0 == decontaminate.leaks(frame(spark, docs), bench.limit(0)).count()


def test_pipeline_against_brute_force(spark, tmp_path):
    r = random.Random(9)
    good = [(i, "menu of the site\n" + text(r, 90) + ".") for i in range(40)]
    junk = [(200 + i, " ".join(w + "###" for w in text(r, 90).split())) for i in range(40)]
    item = text(r, 20)
    rows = good + junk + [(300, edited(r, good[0][1], 1)), (301, good[1][1])] + [(400, text(r, 70) + " " + item + " " + text(r, 30) + ".")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d < 200 or d >= 300), 0) for d, _ in rows[:80]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality classifier"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {d for d, _ in rows if d < 200 or d >= 300}
    cleaned = stages["line dedup"](spark, kept, str(tmp_path))
    texts = {x.doc_id: x for x in cleaned.collect()}
    assert cleaned.columns == docs.columns and all(x.n_chars == len(x.text) for x in texts.values())
    assert not any("menu" in texts[d].text for d in [*range(40), 301])
    assert stages["decontamination"](spark, cleaned, str(tmp_path)).columns == docs.columns
    force = classes_by_force([(x.doc_id, x.text) for x in texts.values()])
    left = {d for d, c in force.items() if d == c} - {d for d, _ in leaks_by_force([(x.doc_id, x.text) for x in texts.values()], [(1, item)])}
    got = {x.doc_id: x.ids_sha256 for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == left == set(range(40))
    assert got == {x.doc_id: x.ids_sha256 for x in bpe.op2(cleaned).collect() if x.doc_id in left}


#: Names that the stages use, or have used, for columns of their own.
OWN = ("_id", "_key", "_stat", "_score", "_leaked", "_line_kept", "_line_total", "_line_dropped", "_line_drop", "_line_host", "_row", "_words", "_hashes", "_stays", "row", "clean", "kept", "of", "id", "bands", "sketch")


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, empty tables, and columns whose names other code uses."""
    r = random.Random(10)
    a, b = text(r, 80), text(r, 80)
    item = text(r, 12)
    rows = [(1, a), (1, a), (2, edited(r, a, 1)), (3, None), (4, ""), (5, ""), (None, b), (None, None), (6, b), (6, item + " " + text(r, 40)), (7, "one two"), (8, "x" * 300_000 + " y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, class_id long, host string, key binary, item long, node long, " + ", ".join(f"{c} string" for c in OWN)
    frame_of = lambda rows: spark.createDataFrame([(d, t, None, None if d == 4 else "s", len(t or ""), 0.1, 1, "h", b"k", 2, 3, *OWN) for d, t in rows], schema)
    spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item, "clash"), (2, None, ""), (None, "", "")], "item_id long, text string, doc_id string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (rows, []):
        docs = frame_of(given)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
            assert {tuple(x[c] for c in OWN) for x in out.collect()} <= {OWN}, name
            docs = Scratch(spark, "test").write(out, "stage")
        left = sorted(((x.doc_id, (x.text or "")[:20]) for x in docs.collect()), key=str)
        if given:
            assert left == sorted([(1, a[:20]), (3, ""), (4, ""), (None, b[:20]), (None, ""), (6, b[:20]), (7, "one two"), (8, "x" * 20)], key=str)
        got = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert got.count() == len(left) and got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_size_classes_decide_what_is_verified(spark, monkeypatch):
    """A leak is found in the class of its item; with that class's index gone, or its bounds wrong, it is not."""
    r = random.Random(7)
    items = [(1, text(r, 8)), (2, text(r, 30)), (3, text(r, 120))]
    docs = frame(spark, [(10 + i, text(r, 20) + " " + t) for i, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    sizes = decontaminate.size_classes
    for inline in (50_000, 0):
        monkeypatch.setattr(decontaminate, "MAX_INLINE", inline)
        found = lambda: {(x.doc_id, x.item_id) for x in decontaminate.leaks(docs, bench).collect()}
        monkeypatch.setattr(decontaminate, "size_classes", sizes)
        assert found() == {(11, 1), (12, 2), (13, 3)}
        wrong = lambda index: [type(x)(**(x.asDict() | ({"top": -(1 << 63)} if x["class"] == 4 else {}))) for x in sizes(index)]
        monkeypatch.setattr(decontaminate, "size_classes", wrong)
        assert found() == {(11, 1), (13, 3)}
        wrong = lambda index: [type(x)(**(x.asDict() | ({"least": 10**6} if x["class"] == 6 else {}))) for x in sizes(index)]
        monkeypatch.setattr(decontaminate, "size_classes", wrong)
        assert found() == {(11, 1), (12, 2)}
