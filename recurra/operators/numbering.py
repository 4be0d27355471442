"""Dense running numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from recurra.session import stage


def number_rows(df: DataFrame, order: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """Add ``name`` = first, first+1, ... in ``order``, without a one-task sort.

    Rows are range partitioned and sorted, so the generated id holds the partition
    number (upper bits) and the place within it (lower 33 bits). The table is written
    once, the partition sizes are summed up, and each row adds its partition's offset.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    written = stage(placed, "numbered")
    part = F.shiftrightunsigned("__at", 33)
    sizes = written.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    # One row per written partition from here on.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset")
    )
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        written.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .select(
            (F.col("__offset") + place + F.lit(first)).cast("long").alias(name),
            *df.columns,
        )
    )
