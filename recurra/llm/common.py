"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows handled at once inside a task; Spark itself limits an Arrow batch to 64 MB.
CHUNK_ROWS = 1000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def map_batches(
    df: DataFrame,
    schema: str,
    per_batch: Callable[[pa.RecordBatch], dict | Iterator[dict]],
    rows: int = CHUNK_ROWS,
    at_end: Callable[[], object] | None = None,
) -> DataFrame:
    """``mapInArrow`` for a function from a batch to columns (a dict of lists or arrays).

    ``at_end`` runs at the end of each task, to drop what the function has kept: workers outlive
    their tasks, and what they hold on to adds to what later tasks of the executor need.
    """
    target = to_arrow_schema(StructType.fromDDL(schema))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                made = per_batch(whole.slice(at, rows))
                for columns in [made] if isinstance(made, dict) else made:
                    arrays = [
                        x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                        for x, f in ((columns[f.name], f) for f in target)
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from convert(batches)
        finally:
            if at_end:
                at_end()
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return what this process has freed to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def row_key(*columns: str) -> Column:
    """96 bits that stand for a row's columns, nulls included; rows alike in them are alike."""
    given = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in columns]
    return F.struct(F.xxhash64(*given).alias("a"), F.hash(*given).alias("b"))


#: Rows up to which a narrow written table (a key of some bytes) is broadcast.
SMALL_ROWS = 500_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count proves that it has at most ``rows`` rows; beyond,
    the join that Spark picks stands. For narrow written tables, which are cheap to count."""
    return F.broadcast(df) if df.count() <= rows else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name
