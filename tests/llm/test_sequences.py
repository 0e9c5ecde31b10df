"""Suffix dedup, structure repair and centroid clustering against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import centroids, repair, suffix_dedup

# Suffix dedup


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def messy_texts(r, n=120):
    """Texts with shared passages at any offset, edits, periods, exact copies and characters of several bytes."""
    passages = ["".join(r.choice("abcdé日 ") for _ in range(r.randint(10, 120))) for _ in range(8)]
    texts = []
    for _ in range(n):
        t = "".join(r.choice([r.choice(passages), "".join(r.choice("abcdefgh é") for _ in range(r.randint(0, 40))), "ab" * r.randint(0, 20)]) for _ in range(r.randint(0, 8)))
        if t and r.random() < 0.3:
            at = r.randrange(len(t))
            t = t[:at] + r.choice("xyz") + t[at + 1 :]
        texts.append(t)
    return [*texts, *texts[:10], None, "", "z", "a" * 900, "a" * 901, passages[0]]


@pytest.mark.parametrize("length", [8, 9, 10, 11, 12, 29, 30, 31, 85])
def test_difference_cover_equals_counting(length):
    r = random.Random(length)
    for _ in range(30):
        rows = ["".join(r.choice("ab") for _ in range(r.randint(0, 40))) * r.randint(1, 4) for _ in range(6)]
        data, starts, own = b"", [], []
        for row in rows:
            starts += [len(data) + i for i in range(len(row) - length + 1)]
            own += [row[i : i + length] for i in range(len(row) - length + 1)]
            data += row.encode()
        got = suffix_dedup.repeated_suffixes(np.frombuffer(data, np.uint8), np.array(starts, np.int64), length)
        count = Counter(own)
        assert got.tolist() == [count[x] > 1 for x in own]


@pytest.mark.parametrize(("length", "limits"), [(20, {}), (20, {"hot": 2, "piece": 64, "ordered": 100}), (27, {"hot": 0}), (33, {"piece": 40}), (8, {})])
def test_removed_bytes_equal_brute_force(spark, length, limits):
    texts = messy_texts(random.Random(length))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, doc string").repartition(3)
    rows = suffix_dedup.drop_repeats(docs, length=length, **limits).select("row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept or b"")) for r in rows}
    assert got == dict(enumerate(brute_removed(texts, length))) and {r.doc for r in rows} == {"x"}


def test_suffix_dedup_repeated_rows_and_clashing_columns(spark):
    text = "".join(chr(97 + (i * i) % 23) for i in range(600))
    names = ["doc", "key", "start", "n", "anchor", "context", "row", "bytes", "spans", "kept"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, t, *names) for i, t in [(1, text), (1, text), (None, text[:450]), (2, None), (3, "y" + text[150:560]), (4, "é" * 300)]]
    got = suffix_dedup.drop_repeats(spark.createDataFrame(rows, schema)).collect()
    want = brute_removed([r[1] for r in rows], 400)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(w[:4] for w in want)
    assert all(list(r.row)[2:] == names for r in got)
    assert suffix_dedup.drop_repeats(spark.createDataFrame([], schema)).count() == 0
    assert suffix_dedup.op11(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op11_on_whole_table(spark):
    from weftline.llm.queries import op11_suffix_dedup

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {r.doc_id: w[:4] for r, w in zip(rows, brute_removed([r.text for r in rows], 400), strict=True)}
    assert got == want and any(w[1] for w in want.values())


# Structure repair


def brute_repair(rows):
    """(cost, audit, repaired rows) by search over all rows and states with whole audits; rows are (role, text, fault)."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}  # 0 nothing, 1 s, 2 u, 3 a
    memo = {}

    def best(i, state, left):
        if (i, state, left) in memo:
            return memo[i, state, left]
        options = []
        if i == len(rows):
            if state in (0, 3):
                options.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            c, a, out = best(i + 1, state, 3)
            options.append((c + 4, "D" + a, out))
            if fault in ("none", "truncated"):
                extra, to = 3 * (fault == "truncated"), after[state]
                if role[:1] == "s" and state == 0:
                    c, a, out = best(i + 1, 1, 3)
                    options.append((c + extra, "K" + a, (f"{role}:{text}", *out)))
                if role[:1] == ("u" if to == 2 else "a"):
                    c, a, out = best(i + 1, to, 3)
                    options.append((c + extra, "K" + a, (f"{role}:{text}", *out)))
                c, a, out = best(i + 1, to, 3)
                options.append((c + 3 + extra, "R" + a, (("user" if to == 2 else "assistant") + ":" + text, *out)))
        if left:
            c, a, out = best(i, after[state], left - 1)
            options.append((c + 3, "I" + a, (("user:" if after[state] == 2 else "assistant:"), *out)))
        memo[i, state, left] = min(options, default=(10**9, "", ()))
        return memo[i, state, left]

    return best(0, 0, 3)


def brute_op12(table):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        said = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(said).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, white = set(), [], " \t\n\x0b\x0c\r"
        for _, role, text in rows:
            last = text.rstrip(white)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "none")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, repaired = brute_repair([(r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def as_dict(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_solver_equals_search():
    r = random.Random(3)
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for n in range(9):
        for _ in range(150):
            rows = [(r.choice("suuaax"), r.choice(["none", "none", "none", "truncated", "duplicate", "blank"])) for _ in range(n)]
            signature = "".join(repair.code(*x) for x in rows)
            cost, audit, _ = brute_repair([(roles[a], "t", b) for a, b in rows])
            assert repair.solve(signature) == (cost, audit), rows
    assert repair.solve("") == (0, "") and repair.measure("") == (0, 0, 0, 0)
    long = "".join(repair.code(r.choice("sua"), "none") for _ in range(200_000))
    assert sum(e != "I" for e in repair.solve(long)[1]) == len(long)


def test_op12_equals_brute_force_on_whole_table(spark):
    from weftline.llm.queries import op12_structure_repair

    rows = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet").collect()
    want = brute_op12([(x.conv_id, x.turn, x.role, x.text) for x in rows])
    assert as_dict(op12_structure_repair(spark, "/root/testdata/sf0.1")) == want


def test_op12_odd_rows(spark):
    r = random.Random(9)
    rows = [(r.choice([None, 1, 2, 3]), r.choice([None, 0, 1, 2, 5]), r.choice([None, "user", "assistant", "system", "tool", ""]), r.choice([None, "", " \n", "ok", "ok.", "Why?", "日。", "x" * 5_000])) for _ in range(120)]
    rows += [(7, t, "user", "Hi.") for t in range(300)] + [(8, i, "assistant", f"say {i}.") for i in range(500)]
    rows += [(c, None, "user", "a") for c in range(100, 140)] + [(c, 0, "user", "b!") for c in range(200, 240)]
    frame = spark.createDataFrame([(*x, "extra") for x in rows], "conv_id long, turn long, role string, text string, signature string").repartition(5)
    got, want = as_dict(repair.op12(frame)), brute_op12(rows)
    ties = {conv for conv in want if Counter((t, x) for c, t, x, _ in rows if c == conv).most_common(1)[0][1] > 1}
    assert got.keys() == want.keys() and {c: got[c] for c in want if c not in ties} == {c: want[c] for c in want if c not in ties}
    assert all(got[c][:2] == want[c][:2] for c in ties)
    assert any(v[-1] == hashlib.sha256(b"").hexdigest() for v in got.values())
    assert repair.op12(spark.createDataFrame([], frame.schema)).count() == 0


# Centroid clustering


def brute_clusters(rows, k=8, rounds=10, dimensions=64):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2**52 else int(x) * 1024 for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, of, strict=True) if o == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [nearest(v) for _, v in kept]
    inertia = Counter()
    for d, j in last:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(((i, j, fit(d), fit(inertia[j]), fit(sum(inertia.values())), digest[j]) for (i, _), (d, j) in zip(kept, last, strict=True)), key=str)


def clusters(df):
    return sorted((tuple(r) for r in centroids.op13(df).collect()), key=str)


def test_op13_equals_plain_rounds_on_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert clusters(frame) == brute_clusters([(r.vec_id, r.embedding) for r in frame.collect()])


def test_op13_ties_odd_and_huge_vectors(spark):
    r = random.Random(5)
    grid = [(i, [float(r.choice([0, 1])) / 1024 if d < 3 else 0.0 for d in range(64)]) for i in range(150)]
    odd = [(None, [0.5] * 64), (1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [None] * 64), (6, [math.nan] * 64), (7, [math.inf] * 64), (8, [-1e-9] * 64)]
    schema = "vec_id long, embedding array<double>, cluster string, upper string"
    for rows in (grid, grid + grid[:20] + odd, odd, grid[:3], [*grid[:30], (900, [7e4] * 64), (901, [-7e4] * 64), (902, [3e38] * 64), (903, [1e300] * 64)]):
        frame = spark.createDataFrame([(*x, "c", "u") for x in rows], schema).repartition(3)
        assert clusters(frame) == brute_clusters(rows)
    assert centroids.op13(spark.createDataFrame([], schema)).count() == 0


def test_bounds_skip_distances_and_keep_them_exact():
    r = np.random.default_rng(4)
    centres = r.integers(-2000, 2000, (8, 16)).tolist()
    vectors = np.concatenate([np.array(c) + r.integers(-60, 60, (200, 16)) for c in centres])
    cluster, upper, lower, before = np.zeros(len(vectors), np.int32), np.full(len(vectors), np.inf), np.zeros((len(vectors), 8)), centres
    calculated = 0
    for _ in range(6):
        bounds = centroids.Bounds(centres, before)
        cluster, best, known, upper, lower = bounds.assign(vectors, cluster, upper, lower)
        calculated += bounds.calculated
        exact = np.array([centroids.distances(vectors, c) for c in centres])
        assert (cluster == exact.argmin(axis=0)).all() and (best[known] == exact.min(axis=0)[known]).all()
        assert (upper**2 >= exact.min(axis=0)).all() and (lower**2 <= exact.T).all()
        before, centres = centres, centroids.moved(centres, {j: (int((cluster == j).sum()), vectors[cluster == j].sum(axis=0).tolist()) for j in range(8) if (cluster == j).any()})
    assert calculated < 6 * len(vectors) * 8 / 3
