"""Hard negatives against brute force: ties, windows, odd vectors, many chunks."""

import math
import random

import numpy as np
import pytest

from sparkpipe.llm import negatives as N
from sparkpipe.llm.common import prepare

SCHEMA = "vec_id long, label int, embedding array<float>, score long, positives int"


def frame(spark, rows):
    return prepare(spark).createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def brute(rows, k=5, m=10):
    clean = {}
    for i, label, vec in rows:
        if None in (i, label, vec) or not vec or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        clean[i] = min(clean.get(i, ((math.inf,), 0)), ([math.floor(256.0 * float(np.float32(x))) for x in vec], label), key=lambda r: (list(r[0]), r[1]))
    out = []
    for a, (q, own) in clean.items():
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, label) for i, (v, label) in clean.items() if i != a)
        for p, pid in [(-s, i) for s, i, label in scores if label == own][:k]:
            found = [(i, -s) for s, i, label in scores if label != own and 30 * p <= -100 * s <= 90 * p][:m]
            out += [(a, pid, r, i, p, s) for r, (i, s) in enumerate(found, 1)]
    return sorted(out)


def got(spark, rows, **options):
    vectors = N.quantised(frame(spark, rows))
    return sorted(map(tuple, N.mine(vectors, vectors.where("vec_id % 100 = 0"), **options).collect()))


def vectors(rng, n, width, spread, labels):
    middles = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(8)]
    return [(i, rng.randrange(labels), [x + rng.gauss(0, spread) for x in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("width,spread,options", [
    (3, 0.3, {}), (6, 0.1, {"chunk": 50, "sample": 60, "block": 3}), (20, 1.0, {"chunk": 100, "cells": 2, "sample": 20})])
def test_mining_equals_brute_force(spark, width, spread, options):
    rng = random.Random(width)
    rows = vectors(rng, 900, width, spread, 10)
    rows += [(i, i % 3, rows[0][2]) for i in range(2000, 2300)]  # one very common vector
    want = brute(rows)
    assert len(want) > 100 and got(spark, rows, **options) == want


def test_odd_vectors(spark):
    rng = random.Random(4)
    rows = vectors(rng, 300, 4, 0.5, 3)
    rows += [(400, None, [1.0] * 4), (500, 1, None), (600, 1, [1.0, None, 1.0, 1.0]), (700, 2, [1.0, math.nan, 0.0, 0.0]),
             (701, 2, [math.inf, 0.0, 0.0, 0.0]), (None, 1, [9.0] * 4), (800, 0, [0.0] * 4), (801, 1, [0.0] * 4), (901, 1, []),
             (1000, 2, [0.5] * 4), (1000, 2, [0.5] * 4), (1100, 1, [1e4, -1e4, 1e4, 1e4])]
    assert got(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert got(spark, []) == []
    assert got(spark, [(100, 1, [1.0, 0.0])]) == []
    rows = [(100, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 0.0]), (3, 3, [0.9, 0.0]), (4, 3, [0.91, 0.0])]
    assert got(spark, rows) == brute(rows) != []


def test_huge_scores_stay_exact(spark):
    rows = [(100, 1, [3e6, 1.0]), (1, 1, [3e6, 3.0]), *((i, 2, [2e6, float(i)]) for i in range(2, 30))]
    assert got(spark, rows) == brute(rows) != []


def test_tree_covers_and_bounds():
    rng = np.random.default_rng(5)
    x = np.floor(rng.standard_normal((500, 5)) * 40 + rng.integers(0, 4, 500)[:, None] * 60)
    tree, q = N.CoverTree(x, leaf=4), np.floor(rng.standard_normal(5) * 100)
    scores, rows = x @ q, []

    def below(node):
        out = set(tree.rows[node].tolist())
        for kid, centre in zip(tree.kids[node].tolist(), tree.centres[node].tolist(), strict=True):
            under = below(kid)
            low, high = N.bounds(np.array([scores[centre]]), np.array([tree.radius[kid]]), float(np.sqrt(q @ q)), tree.top)
            assert all(low[0] <= scores[r] <= high[0] for r in under)
            assert tree.radius[kid] <= tree.radius[node] / 2 and not out & under
            out |= under
        return out
    assert below(tree.root) == set(range(500))
    # a search looks at a part of the rows only
    search = N.Search(tree, lambda r: (x[r] @ q).astype(np.int64), np.arange(500), np.ones(500, bool), q)
    want = sorted(zip((-scores).astype(int).tolist(), range(500), strict=True))
    assert search.best(3, -10**9, 10**9) == want[:3]
    assert sum(len(v[0]) for v in search.seen.values()) < 250
