"""Ordered per-key scans: running sums, previous value, next value.

Keys of ordinary size use a window over the key. A hot key is cut along its own order
into range slices; each slice is scanned on its own, and what the slices before (or
after) it contribute is added from one summary row per slice and key. No task ever
holds more than one slice, however large a key is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.operators.hotkeys import HotKeys, find_hot_keys
from recurra.session import stage

SLICE = "__slice"
_START, _NOW = Window.unboundedPreceding, Window.currentRow


@dataclass(frozen=True)
class RunningSum:
    """Sum over the rows up to and including this one."""
    value: Column


@dataclass(frozen=True)
class First:
    """Value on the first row of the key; it must not be NULL."""
    value: Column


@dataclass(frozen=True)
class Earlier:
    """Nearest non-NULL value on an earlier row."""
    value: Column


@dataclass(frozen=True)
class Latest:
    """Nearest non-NULL value on this row or an earlier one."""
    value: Column


@dataclass(frozen=True)
class Later:
    """Nearest non-NULL value on a later row."""
    value: Column


Op = RunningSum | First | Earlier | Latest | Later


class Ordered:
    """A frame in per-key order, on which scans can be chained."""

    def __init__(self, frame: DataFrame, sliced: DataFrame | None,
                 key: Sequence[str], order: Sequence[str]):
        self._frame, self._sliced = frame, sliced
        self._key, self._order = list(key), list(order)

    def apply(self, step: Callable[[DataFrame], DataFrame]) -> "Ordered":
        """Run a row-wise step (columns, filters) that keeps keys and order."""
        sliced = step(self._sliced) if self._sliced is not None else None
        return Ordered(step(self._frame), sliced, self._key, self._order)

    def scan(self, **ops: Op) -> "Ordered":
        """Add one column per named operation."""
        sliced = self._scan_slices(ops) if self._sliced is not None else None
        return Ordered(_scan(self._frame, self._key, self._order, ops),
                       sliced, self._key, self._order)

    def frame(self) -> DataFrame:
        if self._sliced is None:
            return self._frame
        return self._frame.unionByName(self._sliced.drop(SLICE))

    def _scan_slices(self, ops: dict[str, Op]) -> DataFrame:
        group = [SLICE, *self._key]
        position = F.struct(*self._order)
        edges = self._sliced.groupBy(*group).agg(
            *[_slice_total(op, position).alias(name) for name, op in ops.items()]
        )
        by_slice = Window.partitionBy(*self._key).orderBy(SLICE)
        before = by_slice.rowsBetween(_START, -1)
        carried = edges.select(
            *[F.col(c).alias(f"__e_{c}") for c in group],
            *[_carry(name, op, by_slice, before).alias(f"__c_{name}")
              for name, op in ops.items()],
        )
        local = _scan(self._sliced, group, self._order, ops)
        match = reduce(lambda a, b: a & b,
                       [local[c].eqNullSafe(carried[f"__e_{c}"]) for c in group])
        # One row per slice and hot key: no more than slices plus hot keys.
        joined = local.join(F.broadcast(carried), match, "inner")
        merged = {
            n: _merge(op, F.col(n), F.col(f"__c_{n}")).cast(local.schema[n].dataType)
            for n, op in ops.items()
        }
        return joined.select(
            *[merged.pop(c).alias(c) if c in merged else F.col(c) for c in local.columns]
        )


def ordered(df: DataFrame, key: Sequence[str], order: Sequence[str],
            hot: HotKeys | None = None) -> Ordered:
    """Put ``df`` in ``order`` within ``key``; pass ``hot`` when it is already known."""
    hot = find_hot_keys(df, key) if hot is None else hot
    if not hot:
        return Ordered(hot.dealt(df), None, key, order)
    cut = (
        hot.hot(df)
        .repartitionByRange(hot.slices, *key, *order)
        .withColumn(SLICE, F.spark_partition_id())
    )
    # Written once, so that slice numbers stay the same for every later read.
    return Ordered(hot.dealt(hot.cold(df)), stage(cut, "slices"), key, order)


def _scan(df: DataFrame, key: list[str], order: list[str], ops: dict[str, Op]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    inputs = df.withColumns({name: op.value for name, op in ops.items()})
    outputs = {}
    for name, op in ops.items():
        value = F.col(name)
        if isinstance(op, RunningSum):
            outputs[name] = F.sum(value).over(w.rowsBetween(_START, _NOW))
        elif isinstance(op, First):
            outputs[name] = F.first(value).over(w.rowsBetween(_START, _NOW))
        elif isinstance(op, Earlier):
            outputs[name] = F.last(value, ignorenulls=True).over(w.rowsBetween(_START, -1))
        elif isinstance(op, Latest):
            outputs[name] = F.last(value, ignorenulls=True).over(w.rowsBetween(_START, _NOW))
        else:
            outputs[name] = F.expr(f"lead(`{name}`) ignore nulls").over(w)
    return inputs.withColumns(outputs)


def _slice_total(op: Op, position: Column) -> Column:
    if isinstance(op, RunningSum):
        return F.sum(op.value)
    at = F.when(op.value.isNotNull(), position)
    if isinstance(op, (First, Later)):
        return F.min_by(op.value, at)
    return F.max_by(op.value, at)


def _carry(name: str, op: Op, by_slice, before) -> Column:
    if isinstance(op, RunningSum):
        return F.sum(name).over(before)
    if isinstance(op, First):
        return F.first(name).over(before)
    if isinstance(op, Later):
        return F.expr(f"lead(`{name}`) ignore nulls").over(by_slice)
    return F.last(name, ignorenulls=True).over(before)


def _merge(op: Op, local: Column, carried: Column) -> Column:
    if isinstance(op, RunningSum):
        both = F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
        return F.when(local.isNotNull() | carried.isNotNull(), both)
    if isinstance(op, First):
        return F.coalesce(carried, local)
    return F.coalesce(local, carried)
