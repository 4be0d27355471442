"""Tables stored in named parts, of which a write replaces or extends just those it touches.

A write puts its files in a folder of its own, a subfolder per part. Its last step adds one small
file to the table's manifest, which says what folder each part has gained and which parts have
lost theirs. Readers go by the manifest: they see all of a write or none of it, and files of a
write that was lost half way are never read. Of two writes that start from the same version the
second one fails at that step. Folders that no part has any more can be expired.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

DEFAULT = "default"

_PART = "part_of"
_NAME = re.compile(r"[A-Za-z0-9_-]+")
_MANIFEST = (
    "version long, part string, folder string, replaces boolean, low timestamp_ntz, "
    "high timestamp_ntz, last_number long"
)


@dataclass(frozen=True)
class Range:
    """The times from ``low`` to before ``high``, and the part they go to."""
    name: str
    low: datetime
    high: datetime


class PartTable:
    """A table at ``path`` whose rows are sorted by ``order`` within each part.

    The manifest has a row per part and write and is read to the driver: its size follows the
    number of parts, not of rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 order: Sequence[str]):
        self._spark, self._path, self._schema = spark, path.rstrip("/"), schema
        self._order = list(order)

    def history(self) -> list[T.Row]:
        """The manifest's rows, oldest first; none if nothing has been written."""
        try:
            rows = self._spark.read.schema(_MANIFEST).parquet(f"{self._path}/manifest").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows, key=lambda r: (r.version, r.part))

    def folders(self) -> dict[str, list[str]]:
        """The folders each part has now."""
        live: dict[str, list[str]] = {}
        for row in self.history():
            own = live.setdefault(row.part, [])
            if row.replaces:
                own.clear()
            if row.folder:
                own.append(f"{self._path}/{row.folder}")
        return live

    def read(self, parts: Collection[str] | None = None) -> DataFrame:
        """The rows of the named parts, by default of all; only their folders are listed."""
        found = [
            folder for part, own in self.folders().items()
            if parts is None or part in parts for folder in own
        ]
        if not found:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*found)

    def last_number(self) -> int:
        """The highest surrogate key that writes have told of."""
        return max((r.last_number or 0 for r in self.history()), default=0)

    def ranges(self) -> list[Range]:
        """The declared ranges in order of time."""
        declared = [Range(r.part, r.low, r.high) for r in self.history() if r.low is not None]
        return sorted(declared, key=lambda r: r.low)

    def write(self, df: DataFrame, part: Column, replace: Collection[str] = (),
              declare: Collection[Range] = (), number: str | None = None) -> None:
        """Add ``df``, each row to the part named by ``part`` (null: the default one).

        Parts in ``replace`` lose what they held, all others keep it. ``number`` is a surrogate
        key whose highest value the manifest is to remember.
        """
        version = max((r.version for r in self.history()), default=0) + 1
        folder = f"data/{version}-{uuid.uuid4().hex}"
        # By ranges, so that one part with much of the data goes to many tasks and files.
        keys = [_PART, *self._order]
        (
            df.select(*self._schema.names, F.coalesce(part, F.lit(DEFAULT)).alias(_PART))
            .repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .write.option("compression", "zstd")
            .partitionBy(_PART)
            .parquet(f"{self._path}/{folder}")
        )
        with_part = T.StructType([*self._schema.fields, T.StructField(_PART, T.StringType())])
        written = self._spark.read.schema(with_part).parquet(f"{self._path}/{folder}")
        highest = F.max(number) if number else F.lit(None)
        rows = [
            (version, r[0], f"{folder}/{_PART}={r[0]}", r[0] in replace, None, None, r[1])
            for r in written.groupBy(_PART).agg(highest.cast("long")).collect()
        ]
        gained = {r[1] for r in rows}
        if wrong := [name for name in gained if not _NAME.fullmatch(name)]:
            raise ValueError(f"not names of parts: {wrong[:3]}")
        rows += [(version, name, None, True, None, None, None) for name in set(replace) - gained]
        rows += [(version, r.name, None, False, r.low, r.high, None) for r in declare]
        commit = self._spark.createDataFrame(rows, _MANIFEST).drop("version").coalesce(1)
        commit.write.mode("error").parquet(f"{self._path}/manifest/version={version}")


class RangeTable:
    """A table whose rows go to the part of the declared range their time falls into, or to the
    default part; declaring a range moves what the default part holds of it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, time: str,
                 order: Sequence[str] = ()):
        self.parts = PartTable(spark, path, schema, [time, *order])
        self._time = time

    def append(self, df: DataFrame) -> None:
        self.parts.write(df, range_name(F.col(self._time), self.parts.ranges()))

    def declare(self, *ranges: Range) -> None:
        """Declare ranges and move their rows; a range that overlaps another is refused.

        Only the default part is read and written.
        """
        known = self.parts.ranges()
        for new in ranges:
            if new.low >= new.high or new.name == DEFAULT:
                raise ValueError(f"no range: {new}")
            for old in known:
                if old.name == new.name or (old.low < new.high and new.low < old.high):
                    raise ValueError(f"{new} overlaps {old}")
            known = sorted([*known, new], key=lambda r: r.low)
        held = self.parts.read([DEFAULT])
        self.parts.write(held, range_name(F.col(self._time), known), [DEFAULT], ranges)

    def read(self, low: datetime | None = None, high: datetime | None = None) -> DataFrame:
        """Rows from ``low`` to before ``high``; only parts that can hold some are read."""
        ts, found = F.col(self._time), None
        if low is not None or high is not None:
            found = [DEFAULT] + [
                r.name for r in self.parts.ranges()
                if (high is None or r.low < high) and (low is None or low < r.high)
            ]
        rows = self.parts.read(found)
        if low is not None:
            rows = rows.where(ts >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            rows = rows.where(ts < F.lit(high).cast("timestamp_ntz"))
        return rows


def range_name(ts: Column, ranges: Sequence[Range]) -> Column:
    """The name of the range that a time falls into, else the default: a binary search, written
    as nested conditions over the sorted bounds."""
    if not ranges:
        return F.lit(DEFAULT)
    middle = len(ranges) // 2
    here = ranges[middle]
    return (
        F.when(ts < F.lit(here.low).cast("timestamp_ntz"), range_name(ts, ranges[:middle]))
        .when(ts < F.lit(here.high).cast("timestamp_ntz"), F.lit(here.name))
        .otherwise(range_name(ts, ranges[middle + 1 :]))
    )


def month_ranges(first: datetime, months: int) -> list[Range]:
    """``months`` calendar months from the one of ``first`` on, named ``YYYY_MM``."""
    start = first.year * 12 + first.month - 1
    days = [datetime(k // 12, k % 12 + 1, 1) for k in range(start, start + months + 1)]
    return [Range(f"{a:%Y_%m}", a, b) for a, b in zip(days, days[1:])]
