"""Ad-hoc queries of users: rows or an error as a value, and nothing that writes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import ParseException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

#: Rows fetched to the driver unless more are asked for.
ROWS = 1000


@dataclass(frozen=True)
class Answer:
    """What a statement gave: its first rows, whether there are more, or else why it failed."""
    columns: list[str] = field(default_factory=list)
    rows: list[Row] = field(default_factory=list)
    more: bool = False
    error: str | None = None


def query_frame(spark: SparkSession, text: str) -> DataFrame:
    """The frame of a query in SQL; whatever is not a query raises ValueError unexecuted.

    Only a query can be described as one, which is analysed and not run; statements that write,
    define or configure something do not parse there.
    """
    if not text.strip():
        raise ValueError("there is no statement")
    try:
        spark.sql(f"DESCRIBE QUERY {text}")
    except ParseException as error:
        try:
            spark.sql(f"EXPLAIN {text}")  # parsed, never run
        except ParseException as own:
            raise own from None
        raise ValueError("only queries are answered here") from error
    return spark.sql(text)


def ask(spark: SparkSession, text: str, rows: int = ROWS) -> Answer:
    """Run a query and fetch at most ``rows`` rows; errors of any kind come as a value."""
    try:
        frame = query_frame(spark, text)
        found = frame.limit(rows + 1).collect()
    except PySparkException as error:
        return Answer(error=(error.getMessage() or str(error)).strip())
    except Exception as error:  # noqa: BLE001 - a console answers, whatever went wrong
        return Answer(error=str(error).strip().split("\n")[0])
    return Answer(frame.columns, found[:rows], len(found) > rows)
