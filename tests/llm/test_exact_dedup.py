import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm import odd
from recurra.llm import exact_dedup


def plain_groups(rows, normalise=lambda t: t):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalise(t or "")].append(i)
    out = []
    for i, t in rows:
        same = groups[normalise(t or "")]
        keep = max((x for x in same if x is not None), default=None)
        sha = hashlib.sha256(normalise(t or "").encode()).hexdigest()
        out.append((i, keep, len(same), i == keep, sha))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"filter_rows": 0, "group_rows": 0}])
def test_groups_of_odd_rows(spark, bounds):
    docs = odd.clashing(odd.documents(spark))
    assert found(exact_dedup.exact_groups(docs, **bounds)) == plain_groups(odd.texts())
    assert exact_dedup.exact_groups(docs.limit(0), **bounds).collect() == []


@pytest.mark.parametrize("bounds", [{}, {"filter_rows": 0, "group_rows": 0}])
def test_a_third_of_all_rows_in_one_group(spark, bounds):
    rows = [(i, "copied" if i % 3 == 0 else f"text {i // 7}") for i in range(6000)]
    docs = odd.documents(spark, rows).repartition(7)
    assert found(exact_dedup.exact_groups(docs, **bounds)) == plain_groups(rows)


def test_normalised_texts(spark):
    rows = [(1, "A b"), (2, "a B"), (3, "a  b"), (4, None)]
    groups = exact_dedup.exact_groups(odd.documents(spark, rows), normalise=F.lower)
    assert found(groups) == plain_groups(rows, str.lower)


@pytest.mark.parametrize("bounds", [{}, {"filter_rows": 0, "group_rows": 0}])
def test_keep_one_leaves_whole_rows(spark, bounds):
    docs = odd.clashing(odd.documents(spark))
    kept = exact_dedup.keep_one(docs, **bounds)
    assert kept.columns == docs.columns
    wanted = {}
    for i, t in odd.texts():
        wanted[t or ""] = max(wanted.get(t or "", -1), -1 if i is None else i)
    rows = [(r.text or "", r.doc_id) for r in kept.collect()]
    assert sorted(rows) == sorted(wanted.items())


def test_rows_alone_mostly_pass_straight_through(spark):
    rows = [(i, f"text {i}") for i in range(8000)] + [(9000 + i, "again") for i in range(50)]
    docs = odd.documents(spark, rows).select(
        F.col("doc_id").alias("id"), exact_dedup.digest(F.col("text")).alias("sha")
    )
    flagged = exact_dedup.flag_repeated(docs, len(rows)).groupBy(
        F.col("id") >= 9000, "maybe"
    ).count().collect()
    counts = {(r[0], r[1]): r[2] for r in flagged}
    assert counts[True, True] == 50 and (True, False) not in counts
    assert counts[False, True] < 0.05 * 8000
