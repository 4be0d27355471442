import numpy as np
from pyspark.sql import functions as F

from llm import odd
from recurra.llm import ann

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, query, k):
    at = list(ids).index(query)
    score = x @ x[at]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x += 2 * rng.standard_normal((12, 24))[rng.integers(0, 12, 3000)]
    x[:, :] *= rng.uniform(0.5, 2, (3000, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    rows = ann.search(frame, F.col("id") % 20 == 0, k=10).collect()
    x = x.astype(np.float32).astype(float)
    hits = 0
    for query in range(0, 3000, 20):
        found = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == query)
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        assert np.allclose([f[2] for f in found], [x[f[1]] @ x[query] for f in found])
        hits += len({f[1] for f in found} & {i for i, _ in brute(range(3000), x, query, 10)})
    assert hits / 1500 >= 0.9


def test_equal_vectors_are_split_and_ties_go_to_small_ids(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    rows = [(i, [1.0, 2.0]) for i in range(300)]
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, k=5).collect()
    for query in range(0, 300, 20):
        ids = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == query]
        assert ids == [i for i in range(6) if i != query][:5]


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, []),
        (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]),
        (None, [1.0, 1.0]), (20, [2.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = ann.search(frame, F.col("id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [
        (0, 1, 20, 2.0), (0, 2, 1, 0.5), (20, 1, 0, 2.0), (20, 2, 1, 1.0)
    ]
    assert odd.same_rows(got, ann.search(odd.clashing(frame), F.col("id") % 20 == 0))
    assert ann.search(frame.limit(0), F.col("id") % 20 == 0).collect() == []
    assert ann.search(frame.where("vec_id = 0"), F.col("id") % 20 == 0).collect() == []
