"""Nearest neighbours, periodic runs and hard negatives against brute force, and on nulls, ties, repeats and odd tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import hardnegatives, neighbours, periodic

EXTRA = ["leaf", "v", "n", "ids", "rank", "query", "score", "uid", "zone", "d", "key", "low", "odd.name"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def with_extra(df):
    return df.select("*", *[F.lit(7).alias(c) for c in EXTRA])


def odd_rows(rng, n=900, d=6):
    """Vectors in clumps, a third of them one vector, and rows that take no part or tie."""
    centres = rng.standard_normal((12, d)) * 3
    rows = [(i, (centres[i % 12] + rng.standard_normal(d) * 0.3).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    rows += [(n + i, [0.5] * d, i % 3) for i in range(n // 2)]
    rows += [
        (5000, None, 1), (5100, [0.0] * d, 1), (5200, [1.0, None] + [0.0] * (d - 2), 2), (5300, [float("nan")] * d, 0), (5400, [float("inf")] * d, 0),
        (5500, [], 1), (None, [1.0] * d, 1), (5700, [1.0, 2.0], 1), (5701, [1.0, 2.5], 2), (5702, [1.0, 2.0], 2), (5800, [1.0] * d, None),
        (700, rows[700][1], rows[700][2]), (700, rows[700][1], rows[700][2]), (900, [0.25] * d, 2),
    ]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_rows(np.random.default_rng(4))


@pytest.fixture(scope="module")
def table(spark, rows):
    return with_extra(spark.createDataFrame(rows, SCHEMA)).repartition(5)


# ---- op11 --------------------------------------------------------------------------------------------


def near(rows, k):
    """{(query id, its vector): [(distance, id)]} over the distinct rows that take part."""
    good = {(i, tuple(v)) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in good:
        if i % 100 == 0:
            q = np.array(v, np.float32).astype(float)
            found = {(float(np.sqrt(((np.array(w, np.float32).astype(float) - q) ** 2).sum())), j) for j, w in good if j != i and len(w) == len(v)}
            out[i, v] = sorted(found)[:k]
    return out


def found_neighbours(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return out


def test_neighbours_of_one_leaf_are_exact(table, rows):
    got = found_neighbours(neighbours.search(table, table.filter(F.col("vec_id") % 100 == 0)))
    want = {}
    for (i, _), listed in near(rows, 10).items():
        want.setdefault(i, []).extend((n + 1, s, j) for n, (s, j) in enumerate(listed))
    assert set(got) == {i for i, found in want.items() if found}
    for i, listed in got.items():
        assert sorted((n, j) for n, _, j in listed) == sorted((n, j) for n, _, j in want[i])
        assert np.allclose(sorted(s for _, s, _ in listed), sorted(s for _, s, _ in want[i]), rtol=1e-15)


def test_neighbours_of_a_deep_tree_reach_the_recall(table, rows, monkeypatch):
    for name, value in (("LEAF_ROWS", 40), ("MAX_PARTS", 4), ("SAMPLE_ROWS", 200), ("CELL_ROWS", 64), ("CELL_QUERIES", 2), ("BLOCK_ROWS", 50)):
        monkeypatch.setattr(neighbours, name, value)
    tree = neighbours.fit(neighbours.valid(table, "vec_id", "embedding"))
    assert len(tree.models) > 5  # levels below the first
    got = found_neighbours(neighbours.search(table, table.filter(F.col("vec_id") % 100 == 0)))
    hit = total = 0
    for (i, _), listed in near(rows, 10).items():
        # Ids, as equal distances make equal results.
        hit += len({j for _, j in listed} & {j for _, _, j in got.get(i, [])})
        total += len(listed)
    assert hit >= 0.9 * total


def test_neighbours_of_empty_and_tiny_tables(spark, table):
    none = table.filter("1 = 0")
    assert neighbours.search(none, none).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (100, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.search(few, few.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100, 0.0), (0, 2, 1, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 1.0)]


def test_parts_are_balanced_and_follow_clumps():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal((50, 5)) + 20 * np.eye(5)[i % 5] * (1 + i // 5) for i in range(6)])
    a, b = neighbours.neighbour_graph(x, 8)
    part = neighbours.balanced_parts(a, b, len(x), 6)
    assert np.bincount(part).tolist() == [50] * 6
    assert (part[a] != part[b]).mean() < 0.2


@given(st.integers(1, 60), st.integers(1, 12), st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_nearest_equals_brute_force(n, k, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-2, 3, (n, 3)).astype(float) * 10.0 ** float(rng.integers(-8, 9))
    ids, q, own = rng.permutation(n), x[:5], np.arange(min(n, 5))
    row, col, far = neighbours.nearest(q, own, ids, x, k)
    for i in range(len(q)):
        want = sorted((float(np.sqrt(((x[j] - q[i]) ** 2).sum())), int(ids[j])) for j in range(n) if ids[j] != own[i])[:k]
        assert [(float(f), int(ids[c])) for r, c, f in zip(row, col, far) if r == i] == want


# ---- op12 --------------------------------------------------------------------------------------------


def all_runs(w, exponent=2, least=0):
    """Every maximal repetition with its smallest period, by trying all periods."""
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smaller = (r for r in range(1, q) if all(w[i + t] == w[i + t + r] for t in range(length - r)))
            if j > i and length >= max(least, exponent * q) and next(smaller, None) is None:
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@st.composite
def repetitive(draw):
    w = draw(st.lists(st.integers(0, draw(st.integers(0, 3))), max_size=45))
    if w and draw(st.booleans()):
        a = draw(st.integers(0, len(w) - 1))
        p = 1 + (len(w) - a) // draw(st.integers(3, 10))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    return w


@given(repetitive())
@settings(max_examples=400, deadline=None)
def test_squares_are_all_repetitions(w):
    assert sorted(((s, e - s + 1, p) for (s, p), e in periodic.squares(w).items()), key=lambda r: (r[0], r[2])) == all_runs(w)


@given(st.lists(repetitive(), max_size=5))
@settings(max_examples=200, deadline=None)
def test_cutting_loses_no_run(texts):
    got = periodic.runs_of([[bytes([97 + c]) for c in w] for w in texts])
    assert got == [all_runs(w, 4, 6) for w in texts]


def brute_summary(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        a, p = (h // 10) % n, 0
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = all_runs(words, 4, 6)
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(keep)).hexdigest())
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


def test_periodic_query_equals_brute_force(spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abc") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 70))) for _ in range(60)]
    texts += ["x y " * 40 + "z", "a b c\x1fd \x85 " * 9, "a a a a a a b b b b b b", "a a a a a", None, "", " \t\n\x0b\x0c\r"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "u v " * 6), (3, texts[3]), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("runs", "n_runs", "start", "odd.name")]).repartition(4)
    got = sorted((tuple(r) for r in periodic.summaries(df, prepare=periodic.tail_repeated).collect()), key=repr)
    assert got == sorted((brute_summary(i, t) for i, t in rows), key=repr)
    assert periodic.summaries(df.filter("1 = 0")).count() == 0


def test_runs_and_texts_are_returned(spark):
    df = spark.createDataFrame([(1, "go on " + "la di " * 5 + "end"), (2, "plain")], "doc_id long, text string")
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find(df).collect()}
    assert got == {1: ([(2, 10, 2)], "go on la di end"), 2: ([], "plain")}


def test_text_above_a_slice(spark):
    """A text of 1.6 MB is one run; another has its run after a megabyte of other words."""
    df = spark.createDataFrame([(1, "ab cd efg " * 160_000), (2, " ".join(f"w{i}" for i in range(200_000)) + " q r" * 4)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"]) for r in periodic.summaries(df).collect()}
    assert got == {1: (1, 0, 480_000, 3), 2: (1, 200_000, 8, 2)}


# ---- op13 --------------------------------------------------------------------------------------------


def mined(rows):
    """All (anchor, positive, rank, negative, scores) by trying every pair."""
    good = {(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v), c) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, v, c in good:
        if i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, e) for j, w, e in good if j != i and len(w) == len(v)]
        for ps, pid in sorted(((s, j) for s, j, e in scored if e == c), key=lambda r: (-r[0], r[1]))[:5]:
            inside = sorted(((s, j) for s, j, e in scored if e != c and 30 * ps <= 100 * s <= 90 * ps), key=lambda r: (-r[0], r[1]))[:10]
            out += [(i, pid, n + 1, j, ps, s) for n, (s, j) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("block, zone, bucket", [(256, 16, 64), (20, 4, 5)])
def test_hard_negatives_equal_brute_force(table, rows, monkeypatch, block, zone, bucket):
    monkeypatch.setattr(hardnegatives, "BUCKET_ZONES", bucket)
    got = hardnegatives.mine(table, F.col("vec_id") % 100 == 0, block_rows=block, zone_blocks=zone)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows)


def test_hard_negatives_of_an_empty_table(table):
    assert hardnegatives.mine(table.filter("1 = 0"), F.col("vec_id") % 100 == 0).count() == 0


def test_products_that_doubles_cannot_hold_fail(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0], 1), (1, [1.0, 1.0], 2)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="exact whole numbers"):
        hardnegatives.mine(df, F.col("vec_id") == 0).count()


def test_the_best_so_far_are_kept_across_sendings():
    rng, best, sent = np.random.default_rng(1), hardnegatives._Best(3, 50), []
    every = []
    for _ in range(40):
        part = (rng.integers(0, 30, 9), rng.integers(0, 2, 9), rng.integers(0, 50, 9), rng.integers(0, 10**6, 9))
        every += list(zip(*(c.tolist() for c in part)))
        best.add(*part)
        sent.append(best.flush())
    sent.append(best.flush(end=True))
    assert sum(s is not None for s in sent) > 1
    got = [tuple(r.values()) for s in sent if s is not None for r in s.to_pylist()]
    top = lambda rows: {k: sorted((r for r in rows if r[:2] == k), key=lambda r: (-r[2], r[3]))[:3] for k in {r[:2] for r in rows}}
    assert top(got) == top(every)


def test_bounds_hold_for_every_row_and_spare_blocks(spark, rows):
    """No row lies outside its block's bounds, and in clumped data most blocks need not be read."""
    rng = np.random.default_rng(6)
    z = np.sort(rng.integers(-300, 300, (64, 1)) + rng.integers(-5, 5, (64, 8)), axis=0)
    lo, hi = z.reshape(8, 8, 8).min(1).astype(float), z.reshape(8, 8, 8).max(1).astype(float)

    class A:
        pass

    a = A()
    a.z, a.label = rng.integers(-300, 300, (20, 8)).astype(float), np.zeros(20, np.int64)
    a.low, a.high = np.full((20, 1), 1e5), np.full((20, 1), 2e5)
    meets = hardnegatives._chosen(a, lo, hi, [[1]] * 8, False)
    score = (a.z @ z.T.astype(float)).reshape(20, 8, 8)
    inside = ((score >= 1e5) & (score <= 2e5)).any(2)
    assert not (inside & ~meets).any() and meets.mean() < 0.9


def test_the_curve_visits_neighbouring_cells():
    """In two dimensions all 256 cells are met once, each next to the one before."""
    cells = np.array([(x, y) for x in range(16) for y in range(16)])
    keys = hardnegatives.hilbert_keys(cells, 4)
    assert len(set(keys)) == 256
    path = cells[sorted(range(256), key=lambda i: keys[i])]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
