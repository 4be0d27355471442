"""Writing the star as Parquet, reading it back, and running SQL over it."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recurra.schemas import STAR, enforce_schema
from recurra.session import stage

EVENTS = "fact_subscription_events"
PARTITIONED_BY = ("event_year", "event_month")


def with_month_keys(events: DataFrame) -> DataFrame:
    """Add the partition columns: year, and month as two digits."""
    ts = F.col("event_timestamp")
    return events.select(
        "*",
        F.year(ts).alias("event_year"),
        F.lpad(F.month(ts).cast("string"), 2, "0").alias("event_month"),
    )


def write_table(df: DataFrame, root: str, name: str, months_only: bool = False,
                time_sliced: bool = False, append: bool = False) -> str:
    """Replace a table with ``df`` as ZSTD Parquet; events go by year and month.

    With ``months_only`` just the months found in ``df`` are replaced; with ``append`` its
    rows come on top of the stored ones. ``time_sliced`` says that each partition of ``df`` already covers a stretch of time of its own.

    Event rows are range partitioned by time before the write. A hot month is then
    spread over many tasks, quiet months share one, and every file covers a short time
    span, which its row-group statistics let a filter use.
    """
    path, mode = f"{root}/{name}", "append" if append else "overwrite"
    if name != EVENTS:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
        return path
    order = [*PARTITIONED_BY, "event_timestamp", "event_id"]
    keyed = with_month_keys(df)
    if not time_sliced:
        keyed = keyed.repartitionByRange(*order)
    (
        keyed.sortWithinPartitions(*order)
        .write.mode(mode)
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic" if months_only else "static")
        .partitionBy(*PARTITIONED_BY)
        .parquet(path)
    )
    return path


def next_number(table: DataFrame, key: str) -> int:
    """The first number that a stored table has not given yet."""
    return (table.agg(F.max(key)).first()[0] or 0) + 1


def rewrite_table(df: DataFrame, root: str, name: str) -> str:
    """Replace a table with a frame that reads it.

    The frame is first written whole to the shared folder, so the old table is read to the
    end before it goes, and a job lost in between leaves one of the two complete.
    """
    return write_table(stage(df, name), root, name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read a table with its declared schema; partition columns come as integers."""
    schema = STAR[name]
    if name == EVENTS:
        keys = [T.StructField(column, T.IntegerType(), True) for column in PARTITIONED_BY]
        schema = T.StructType([*schema.fields, *keys])
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in STAR}


def export_star(star: dict[str, DataFrame], root: str) -> dict[str, str]:
    return {
        name: write_table(enforce_schema(df, STAR[name]), root, name)
        for name, df in star.items()
    }


def month_slice(events: DataFrame, year: int, month: int, months: int = 1) -> DataFrame:
    """Events of ``months`` calendar months, half-open in time.

    The time filter reaches the file statistics; where the table has the partition
    columns they are filtered too, so that only those folders are listed and read.
    """
    first = year * 12 + month - 1
    low, high = _first_day(first), _first_day(first + months)
    ts = F.col("event_timestamp")
    found = events.where((ts >= _instant(low)) & (ts < _instant(high)))
    if not set(PARTITIONED_BY) <= set(events.columns):
        return found
    wanted = [
        (F.col("event_year") == d.year) & (F.col("event_month").cast("int") == d.month)
        for d in (_first_day(first + k) for k in range(months))
    ]
    return found.where(reduce(lambda a, b: a | b, wanted))


def time_slice(events: DataFrame, low: datetime, high: datetime,
               time: str = "event_timestamp") -> DataFrame:
    """Rows from ``low`` to before ``high``. Where the table has the partition columns, only the
    folders of the months in between are listed and read, whatever instants the two are."""
    ts = F.col(time)
    found = events.where((ts >= _instant(low)) & (ts < _instant(high)))
    if not set(PARTITIONED_BY) <= set(events.columns):
        return found
    last = high - timedelta(microseconds=1)
    month = F.col("event_year") * 12 + F.col("event_month").cast("int")
    return found.where(month.between(low.year * 12 + low.month, last.year * 12 + last.month))


def register_between(spark: SparkSession, name: str, events: str) -> None:
    """A SQL table function ``name(low, high)``: the rows of the registered events from ``low`` to
    before ``high``, read from the folders of their months alone."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(low TIMESTAMP_NTZ, high TIMESTAMP_NTZ)
        RETURNS TABLE({", ".join(f"{f.name} {f.dataType.simpleString()}"
                                 for f in spark.table(events).schema.fields)})
        RETURN SELECT * FROM {events}
        WHERE event_timestamp >= low AND event_timestamp < high
          AND event_year * 12 + CAST(event_month AS INT) BETWEEN year(low) * 12 + month(low)
          AND year(high - INTERVAL '0.000001' SECOND) * 12
              + month(high - INTERVAL '0.000001' SECOND)""")


def slice_name(ts: Column, low: date, high: date) -> Column:
    """``YYYY_MM`` of the monthly slice in ``[low, high)``, else ``default``."""
    inside = (ts >= _instant(low)) & (ts < _instant(high))
    return F.when(inside, F.date_format(ts, "yyyy_MM")).otherwise(F.lit("default"))


def insert_absent(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``table`` with the rows whose key it does not hold yet."""
    return table.unionByName(rows.join(table.select(key), key, "left_anti"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def register(tables: dict[str, DataFrame]) -> None:
    """Make frames available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql_file(spark: SparkSession, path: str, **args) -> DataFrame:
    """Run one SQL statement from a file over the registered names."""
    text = Path(path).read_text(encoding="utf-8").strip().rstrip(";")
    return spark.sql(text, args=args or None)


def report(name: str) -> str:
    """The path of a SQL file that comes with the library."""
    return str(Path(__file__).resolve().parent.parent / "sql" / f"{name}.sql")


def _first_day(index: int) -> date:
    return date(index // 12, index % 12 + 1, 1)


def _instant(day: date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")
