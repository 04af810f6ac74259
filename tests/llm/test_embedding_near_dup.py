"""Embedding near-duplicates against comparing all vectors of a label."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tirepulse.llm import embedding_near_dup as near

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, threshold=0.93):
    """vec_id -> (n_links, component_id, kept) of rows with distinct ids."""
    fine = {v: (np.array(e, np.float32).astype(float), lab) for v, e, lab in rows
            if e is not None and lab is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)}
    dim = max((len(e) for e, _ in fine.values()), default=0)
    ids = sorted(fine)
    links = {v: set() for v, *_ in rows}
    for lab in {x for _, x in fine.values()}:
        own = [v for v in ids if fine[v][1] == lab]
        m = np.array([np.pad(fine[v][0], (0, dim - fine[v][0].size)) for v in own])
        m /= np.linalg.norm(m, axis=1)[:, None]
        for i, j in zip(*np.nonzero(m @ m.T >= threshold)):
            if i != j:
                links[own[i]].add(own[j])
    root = {}
    for v in sorted(links):
        if v not in root:
            todo = [v]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = v
                    todo += links[x]
    return {v: (len(links[v]), root[v], root[v] == v) for v in links}


def _planted(seed=2, base=400, dim=32):
    """Random vectors, pairs near the threshold, large groups of near and of exact copies, one hot label."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((base, dim))
    rows = [list(map(float, v)) for v in x]
    label = (rng.integers(0, 3, base) * (rng.random(base) > 0.4)).tolist()
    for k in range(60):                                    # cosine from about 0.90 to 0.99
        rows.append(list(map(float, x[k] + rng.standard_normal(dim) * rng.uniform(0.1, 0.48))))
        label.append(label[k])
    for size, noise in ((150, 0.05), (90, 0.2)):           # more than a window
        centre = rng.standard_normal(dim)
        rows += [list(map(float, centre + noise * rng.standard_normal(dim))) for _ in range(size)]
        label += [0] * size
    rows += [rows[5]] * 80 + [[2 * v for v in rows[6]]] * 3
    label += [label[5]] * 80 + [label[6]] * 3
    ids = rng.permutation(len(rows)).tolist()
    return [(7 * i, e, lab) for i, e, lab in zip(ids, rows, label)]


def _got(df):
    rows = df.collect()
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("params", [near.PassParams(), near.PassParams(window=8, block_rows=48, recall=0.9999)])
def test_classes_and_links_equal_all_pairs(spark, params):
    rows = _planted()
    rows += [(100_000, None, 1), (100_001, [], 1), (100_002, [0.0] * 32, 1), (100_003, [1.0, None], 1), (100_004, [float("nan"), 1.0], 1),
             (100_005, rows[0][1], None), (100_006, rows[0][1][:5], 1), (100_007, rows[0][1][:5] + [0.0], 1), (100_008, [float("inf")], 0)]
    clash = {c: F.lit(3) for c in ("node", "weight", "digest", "pass", "code", "cell", "rank", "vector", "n", "key", "component", "own")}
    df = spark.createDataFrame(rows, SCHEMA).withColumns(clash).repartition(5)
    got, expected = _got(near.near_duplicates(df, params=params)), _brute(rows)
    wrong = {v for v in expected if got[v] != expected[v]}
    # only pairs a little above the threshold may be missed
    assert got.keys() == expected.keys() and len(wrong) <= 0.01 * len(expected), len(wrong)
    found, there = sum(g[0] for g in got.values()), sum(e[0] for e in expected.values())
    assert there > 30_000 and 0.99 * there <= found <= there


def test_recall_at_the_threshold(spark):
    """Pairs with cosines from 0.93 to 0.95 only: at least 0.9 of them are found, none below."""
    rng = np.random.default_rng(9)
    rows, dim = [], 48
    for k in range(1500):
        a = rng.standard_normal(dim)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(dim)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.921, 0.95)
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), 1)]
    got = _got(near.near_duplicates(spark.createDataFrame(rows, SCHEMA), params=near.PassParams(window=16)))
    expected = _brute(rows)
    assert all(got[v][0] <= expected[v][0] for v in expected)
    there = sum(e[0] for e in expected.values())
    assert there > 1500 and sum(g[0] for g in got.values()) >= 0.9 * there


def test_doubles_whose_squares_underflow_or_overflow(spark):
    rows = [(1, [1e-200, 2e-200], 1), (2, [1.0, 2.0], 1), (3, [1e200, 2e200], 1), (4, [-1.0, 2.0], 1), (5, [1e308, 1e-308], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = _got(near.near_duplicates(df))
    assert {v: g[:2] for v, g in got.items()} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def test_repeated_and_unnamed_rows_and_empty_tables(spark):
    v = [1.0, 0.5]
    rows = [(1, v, 2), (1, v, 2), (1, [0.0, 1.0], 2), (2, v, 2), (None, v, 2), (None, None, None), (3, None, None), (3, v, 2)]
    got = sorted(near.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    named = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None}
    # vec_id 1 counts with the smallest of its vectors, which is far from v
    assert named == {1: (0, 1, True), 2: (1, 2, True), 3: (1, 2, False)}
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)] * 2
    assert near.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_more_vectors_take_more_passes():
    p = near.PassParams()
    counts = [near.passes_for(n, p) for n in (0, 64, 1000, 50_000, 10 ** 9)]
    assert counts == sorted(counts) and counts[0] == 1 and counts[-1] < 200
