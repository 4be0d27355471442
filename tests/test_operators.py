"""Ordered scans and numbering on keys of any size, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from recurra.operators.hotkeys import find_hot_keys, lookup
from recurra.operators.numbering import number_rows
from recurra.operators.ordered import Earlier, First, Later, Latest, RunningSum, ordered


def table(spark, hot_rows):
    rng = random.Random(7)
    rows = [("hot", i, rng.choice([None, rng.randrange(100)])) for i in range(hot_rows)]
    rows += [(f"k{i % 20}", i, rng.choice([None, rng.randrange(100)])) for i in range(200)]
    rows += [(None, i, i) for i in range(60)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t int, x int").repartition(5)


@pytest.mark.parametrize("limit", [10_000, 25])
def test_scans(spark, hot_limit, limit):
    hot_limit(limit)
    rows, df = table(spark, 300)
    x = F.col("x")
    out = ordered(df, ["k"], ["t"]).scan(
        total=RunningSum(x), nth=RunningSum(F.lit(1)), first=First(F.col("t")),
        before=Earlier(x), now=Latest(x), after=Later(x),
    ).frame()
    found = {(r["k"], r["t"]): r for r in out.collect()}
    assert len(found) == len(rows)
    groups = {}
    for k, t, value in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        groups.setdefault(k, []).append((t, value))
    for k, group in groups.items():
        values = [v for _, v in group]
        for i, (t, _) in enumerate(group):
            row = found[k, t]
            past, here = values[:i], values[: i + 1]
            assert row["nth"] == i + 1 and row["first"] == group[0][0]
            known = [v for v in here if v is not None]
            assert row["total"] == (sum(known) if known else None)
            assert row["now"] == (known[-1] if known else None)
            assert row["before"] == next((v for v in reversed(past) if v is not None), None)
            assert row["after"] == next((v for v in values[i + 1:] if v is not None), None)


def test_chained_scans_keep_slices(spark, hot_limit):
    hot_limit(25)
    _, df = table(spark, 300)
    out = (
        ordered(df, ["k"], ["t"])
        .scan(before=Earlier(F.struct("x")))
        .apply(lambda d: d.where(~F.col("before.x").eqNullSafe(F.col("x"))))
        .scan(n=RunningSum(F.lit(1)))
        .frame()
    )
    plain = out.where(F.col("k") == "hot").orderBy("t").select("n").collect()
    assert [r["n"] for r in plain] == list(range(1, len(plain) + 1))


def test_hot_keys_are_found_and_bounded(spark):
    _, df = table(spark, 300)
    assert not find_hot_keys(df, ["k"])
    hot = find_hot_keys(df, ["k"], rows=50)
    assert {r["k"] for r in hot.keys.collect()} == {"hot", None}
    assert hot.cold(df).count() == 200 and hot.hot(df).count() == 360
    assert hot.slices == 8


def test_lookup_with_hot_keys(spark, hot_limit):
    hot_limit(50)
    _, df = table(spark, 300)
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(10)], "k string, d int")
    joined = lookup(df, dim, "k")
    assert joined.count() == 300 + 100
    assert lookup(df, dim, "k", "left").count() == df.count()


def test_numbering_is_dense_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    out = number_rows(df, ["v"], "n", first=11)
    assert [tuple(r) for r in out.orderBy("v").collect()] == [(i + 11, i) for i in range(5000)]
