"""Finding keys that own too many rows for one task, and setting them apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from recurra.session import HOT_KEY_ROWS

# A group below FLOOR rows always fits one task; above CEILING it never should.
FLOOR, CEILING = 100_000, 5_000_000

# Rows that a task takes of a table hashed by key, about: beyond, there are more partitions.
TASK_ROWS = 250_000


class HotKeys:
    """The keys holding more than ``rows`` rows; at most ``total / rows`` of them.

    ``slices`` is how many cuts bring their rows back under that limit. ``partitions`` is how
    many tasks the other rows are dealt to by key; None leaves that to Spark.
    """

    def __init__(self, key: Sequence[str], rows: int, keys: DataFrame | None, slices: int = 0,
                 partitions: int | None = None):
        self.key, self.rows, self.keys, self.slices = list(key), rows, keys, slices
        self.partitions = partitions

    def __bool__(self) -> bool:
        return self.keys is not None

    def of_finer(self, key: Sequence[str]) -> "HotKeys | None":
        """For a key that splits this one further: none is hot if none is here, else it
        is not known."""
        return None if self else HotKeys(key, self.rows, None, partitions=self.partitions)

    def dealt(self, df: DataFrame) -> DataFrame:
        """``df`` hashed by key to as many partitions as the rows counted need, so that what a
        task holds does not grow with the table; Spark leaves out a shuffle that changes nothing.
        """
        return df if self.partitions is None else df.repartition(self.partitions, *self.key)

    def cold(self, df: DataFrame) -> DataFrame:
        return df if self.keys is None else self._join(df, "left_anti")

    def hot(self, df: DataFrame) -> DataFrame:
        return df.limit(0) if self.keys is None else self._join(df, "left_semi")

    def _join(self, df: DataFrame, how: str) -> DataFrame:
        # The key list is bounded by total / rows, whatever the data size.
        listed = F.broadcast(self.keys.toDF(*[f"__hot_{k}" for k in self.key]))
        match = reduce(
            lambda a, b: a & b, [df[k].eqNullSafe(listed[f"__hot_{k}"]) for k in self.key]
        )
        return df.join(listed, match, how)


def find_hot_keys(df: DataFrame, key: Sequence[str], rows: int | None = None) -> HotKeys:
    """Count rows per key (combined before the shuffle) and keep those over the limit.

    Without an explicit limit a key is hot when it holds more than half of an even
    share of the shuffle partitions, within FLOOR and CEILING.
    """
    spark = df.sparkSession
    key = list(key)
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    top = sizes.agg(F.sum("__rows").alias("total"), F.max("__rows").alias("top")).first()
    total, largest = top["total"] or 0, top["top"] or 0
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(shuffled, -(-total // TASK_ROWS)) if total > TASK_ROWS else None
    if rows is None:
        named = spark.conf.get(HOT_KEY_ROWS, None)
        share = total // (2 * shuffled)
        rows = int(named) if named else min(CEILING, max(FLOOR, share))
    if largest <= rows:
        return HotKeys(key, rows, None, partitions=partitions)
    found = sizes.where(F.col("__rows") > rows)
    listed = found.collect()  # at most total / rows entries
    slices = -(-sum(r["__rows"] for r in listed) // rows)
    keys = spark.createDataFrame([tuple(r)[:-1] for r in listed], found.drop("__rows").schema)
    return HotKeys(key, rows, keys, slices, partitions)


def by_user(df: DataFrame, hot: HotKeys | None) -> DataFrame:
    """``df`` hashed by user like the rows whose hot users these are."""
    dealt = hot is not None and hot.partitions is not None
    return hot.dealt(df) if dealt else df.repartition("user_id")


def lookup(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
           hot: HotKeys | None = None) -> DataFrame:
    """Join a fact to a dimension that is unique on ``key``, safe for hot fact keys.

    Only the dimension rows of hot keys are broadcast, and there are no more of those
    than hot keys; all other rows take the join Spark chooses from the sizes it sees.
    """
    hot = find_hot_keys(fact, [key]) if hot is None else hot
    cold = hot.cold(fact).join(dim, key, how)
    if not hot:
        return cold
    spread = hot.hot(fact).join(F.broadcast(hot.hot(dim)), key, how)
    return cold.unionByName(spread)
