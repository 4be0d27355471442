"""What bounds a query's distances from the start, and that it loses nothing."""

import numpy as np

from recurra.llm import ann


def index_of(points, lists):
    width = points.shape[1] + 1
    largest = float(np.sqrt((points**2).sum(axis=1).max()))
    none = np.zeros(0, np.int64), np.zeros((0, width)), np.zeros(0, np.int64)
    rotation = np.linalg.qr(np.random.default_rng(1).standard_normal((width, width)))[0]
    bare = ann.Index(np.zeros((1, width)), rotation, largest, lists, 1.0, *none)
    turned = bare.rotated(points)
    bare = ann.Index(turned[:8], rotation, largest, lists, 1.0, *none)
    seen = np.arange(0, len(points), 2)
    return ann.Index(
        turned[:8], rotation, largest, lists, 1.0, seen, turned[seen],
        bare.lists(turned[seen], 1)[:, 0],
    )


def test_bound_keeps_enough_candidates_of_the_probed_lists():
    x = np.random.default_rng(0).standard_normal((600, 40))
    ids, asked = np.arange(600), np.arange(0, 600, 20)
    index = index_of(x, 3)
    turned = index.rotated(x[asked], queries=True)
    lists = index.lists(turned, 3)
    within = index.bounds(turned, asked, lists, 10)
    home = index.lists(index.rotated(x), 1)[:, 0]
    for i, q in enumerate(asked):
        near = np.isin(home, lists[i]) & (ids != q)
        far = ((turned[i] - index.rotated(x)) ** 2).sum(axis=1)
        assert (near & (far <= within[i] * (1 + 1e-9))).sum() >= 10
    few = index.bounds(turned, asked, lists, 500)
    assert np.isinf(few).all()


def test_scan_within_a_bound_finds_the_nearest():
    x = np.random.default_rng(2).standard_normal((800, 64))
    ids, asked = np.arange(800), np.arange(0, 800, 20)
    index = index_of(x, 8)
    turned = index.rotated(x[asked], queries=True)
    within = index.bounds(turned, asked, index.lists(turned, 8), 20)
    hits = 0
    q, found, score = ann.scan(index, ids, x, asked, x[asked], within, 10)
    assert np.allclose(score, (x[asked][q] * x[found]).sum(axis=1))
    for i, query in enumerate(asked):
        exact = x @ x[query]
        exact[query] = -np.inf
        hits += len(set(found[q == i]) & set(np.argsort(-exact)[:10]))
    assert (np.bincount(q) == 10).all()
    assert hits >= 0.99 * 10 * len(asked)
