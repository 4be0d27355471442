"""Point-in-time lookup where versions of a key may overlap: the first one in list order wins.

Rows and versions are merged into one scan per key in order of time, which keeps the versions
open at each instant in a heap by their place in the list. Work is linear but for the heap, and
no pairs of rows and versions are made. A hot key is cut along its order into slices; a slice
begins with the versions still open from earlier ones, less those that can no longer win, because
one that comes before them in the list ends no earlier.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from recurra.operators.hotkeys import HotKeys, find_hot_keys
from recurra.operators.ordered import SLICE
from recurra.session import stage

_KEY, _AT, _KIND, _RANK, _UNTIL, _PICKED = "__key", "__at", "__kind", "__rank", "__until", "__picked"
_FALLBACK, _VERSION, _ROW = 0, 1, 2


def resolve_first(
    df: DataFrame, versions: DataFrame, at: str, columns: Sequence[str] = ("user_sk",),
    key: str = "user_id", rank: str = "user_sk", hot: HotKeys | None = None,
) -> DataFrame:
    """Add the ``columns`` of the first version of ``key``, by ``rank``, that is valid at the
    time in ``at``.

    A version is valid in ``[start_date, end_date)``, without end when NULL; versions may
    overlap. Where none is valid the last one by ``rank`` stands in; a key without versions
    yields NULL. Ranks of one key are distinct.
    """
    columns = list(columns)
    picked = F.struct(*columns).alias(_PICKED)
    rows = df.select(
        F.col(key).alias(_KEY), F.col(at).cast("timestamp_ntz").alias(_AT),
        F.lit(_ROW).alias(_KIND), *df.columns,
    )
    changes = versions.where(F.col("start_date").isNotNull()).select(
        F.col(key).alias(_KEY), F.col("start_date").cast("timestamp_ntz").alias(_AT),
        F.lit(_VERSION).alias(_KIND), F.col(rank).cast("long").alias(_RANK),
        F.col("end_date").cast("timestamp_ntz").alias(_UNTIL), picked,
    )
    # Without a time, so that it comes before everything of its key.
    last = (
        versions.select(F.col(key).alias(_KEY), F.col(rank).alias(_RANK), picked)
        .groupBy(_KEY).agg(F.max_by(_PICKED, _RANK).alias(_PICKED))
        .select(_KEY, F.lit(_FALLBACK).alias(_KIND), _PICKED)
    )
    if hot is None:
        hot = find_hot_keys(rows.select(_KEY).unionAll(changes.select(_KEY)), [_KEY])
    elif hot:
        hot = HotKeys([_KEY], hot.rows, hot.keys.toDF(_KEY), hot.slices)
    merged = changes.unionByName(rows, allowMissingColumns=True)
    cold = hot.cold(merged).unionByName(hot.cold(last), allowMissingColumns=True)
    out = _sweep(cold, [_KEY], df, columns)
    if hot:
        sliced = _sliced(hot.hot(merged), hot.hot(last), hot.slices)
        out = out.unionByName(_sweep(sliced, [_KEY, SLICE], df, columns))
    return out


def _sliced(merged: DataFrame, last: DataFrame, slices: int) -> DataFrame:
    """Rows and versions of hot keys with their slice; each slice begins with the versions open
    from before and the one that stands in."""
    cut = stage(
        merged.repartitionByRange(slices, _KEY, _AT, _KIND).withColumn(
            SLICE, F.spark_partition_id()
        ),
        "overlaps",
    )
    # One row per slice and hot key: no more than slices plus hot keys.
    spans = F.broadcast(cut.groupBy(_KEY, SLICE).agg(F.min(_AT).alias("low")).select(
        F.col(_KEY).alias("of"), F.col(SLICE).alias("into"), "low"
    ))
    ends = F.max(_AT).over(Window.partitionBy(_KEY, SLICE))
    open_after = (
        cut.withColumn("high", ends)
        .where((F.col(_KIND) == _VERSION) & (F.col(_UNTIL).isNull() | (F.col(_UNTIL) > F.col("high"))))
        .select(_KEY, SLICE, _AT, _KIND, _RANK, _UNTIL, _PICKED)
    )
    carried = _able_to_win(open_after, [_KEY, SLICE]).join(
        spans,
        F.col(_KEY).eqNullSafe(F.col("of")) & (F.col(SLICE) < F.col("into"))
        & (F.col(_UNTIL).isNull() | (F.col(_UNTIL) > F.col("low"))),
    ).withColumn(SLICE, F.col("into")).drop("of", "into", "low")
    carried = _able_to_win(carried, [_KEY, SLICE]).withColumn(_AT, F.lit(None).cast("timestamp_ntz"))
    fallback = last.join(spans, last[_KEY].eqNullSafe(F.col("of"))).select(
        *last.columns, F.col("into").alias(SLICE)
    )
    return cut.unionByName(carried, allowMissingColumns=True).unionByName(
        fallback, allowMissingColumns=True
    )


def _able_to_win(versions: DataFrame, group: list[str]) -> DataFrame:
    """Versions that outlast all of their group that come before them in the list."""
    forever = F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")
    until = F.coalesce(F.col(_UNTIL), forever)
    before = Window.partitionBy(*group).orderBy(_RANK).rowsBetween(Window.unboundedPreceding, -1)
    longest = F.max(until).over(before)
    return versions.withColumn("__longest", longest).where(
        F.col("__longest").isNull() | (until > F.col("__longest"))
    ).drop("__longest")


def _sweep(merged: DataFrame, unit: list[str], df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``df`` in ``merged`` with the winner's columns; units are scanned in order."""
    kind = merged.schema[_PICKED].dataType
    schema = StructType([*df.schema.fields, StructField(_PICKED, kind)])
    target = to_arrow_schema(schema)
    picked_type = target.field(_PICKED).type
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, heap, stand_in = None, [], None
        for batch in batches:
            units = list(zip(*[batch.column(c).to_pylist() for c in unit]))
            times = batch.column(_AT).cast(pa.int64()).to_pylist()
            untils = batch.column(_UNTIL).cast(pa.int64()).to_pylist()
            kinds, ranks = (batch.column(c).to_pylist() for c in (_KIND, _RANK))
            chosen, at = [], []
            for i, of in enumerate(units):
                if of != current:
                    current, heap, stand_in = of, [], None
                if kinds[i] == _FALLBACK:
                    stand_in = batch.column(_PICKED)[i].as_py()
                elif kinds[i] == _VERSION:
                    heappush(heap, (ranks[i], untils[i], batch.column(_PICKED)[i].as_py()))
                else:
                    now = times[i]
                    while heap and now is not None and heap[0][1] is not None and heap[0][1] <= now:
                        heappop(heap)
                    chosen.append(heap[0][2] if heap and now is not None else stand_in)
                    at.append(i)
            rows = batch.select(names).take(pa.array(at, pa.int64()))
            found = pa.array(chosen, type=picked_type)
            yield pa.RecordBatch.from_arrays([*rows.columns, found], schema=target)

    placed = merged.repartition(*unit).sortWithinPartitions(*unit, _AT, _KIND)
    swept = placed.mapInArrow(run, schema)
    return swept.select(*names, *[F.col(f"{_PICKED}.{c}").alias(c) for c in columns])
