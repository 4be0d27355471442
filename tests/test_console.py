"""Ad-hoc statements: rows, errors as values, and refusals."""

import pytest
from pyspark.sql import functions as F

from recurra.plans.dimensions import PLAN_CATALOGUE, plan_dimension
from recurra.schemas import DIM_PLAN
from recurra.sources.console import ask


@pytest.fixture(autouse=True)
def numbers(spark):
    spark.range(50).select((49 - F.col("id")).alias("n")).createOrReplaceTempView("numbers")


def test_rows_in_order_and_whether_there_are_more(spark):
    answer = ask(spark, "SELECT n, n % 2 AS odd FROM numbers ORDER BY n; -- that is all", rows=3)
    assert answer.columns == ["n", "odd"] and answer.more and answer.error is None
    assert [r.n for r in answer.rows] == [0, 1, 2]
    whole = ask(spark, "WITH few AS (SELECT n FROM numbers WHERE n < 3) SELECT * FROM few", rows=3)
    assert len(whole.rows) == 3 and not whole.more
    assert ask(spark, "SELECT n, n FROM numbers LIMIT 1").columns == ["n", "n"]
    assert ask(spark, "VALUES (1), (2)").rows == [(1,), (2,)]


@pytest.mark.parametrize("text, part", [
    ("SELECT nothing FROM numbers", "nothing"), ("SELECT * FROM no_such", "no_such"),
    ("SELEC 1", "SELEC"), ("SELECT raise_error('no good')", "no good"), (" \n", "no statement"),
    ("SELECT 1; SELECT 2", "SELECT"),
])
def test_errors_come_as_values(spark, text, part):
    answer = ask(spark, text)
    assert part in answer.error and answer.rows == [] and "Traceback" not in answer.error


@pytest.mark.parametrize("text", [
    "DROP VIEW numbers", "CREATE OR REPLACE TEMPORARY VIEW numbers AS SELECT 1 AS n",
    "CREATE TABLE made USING parquet AS SELECT 1 AS n", "INSERT INTO numbers VALUES (1)",
    "FROM numbers INSERT INTO numbers SELECT n", "SET spark.sql.shuffle.partitions = 1",
    "DELETE FROM numbers", "SHOW TABLES", "n",
])
def test_what_is_no_query_is_refused_unexecuted(spark, text):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    answer = ask(spark, text)
    assert answer.error and answer.rows == []
    assert spark.table("numbers").count() == 50
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert not spark.catalog.tableExists("made")


def test_catalogue_names_may_hold_quotes(spark):
    odd = [("p", "IT'S_M", "It's; \\ \"plan\" {0}", "monthly", 1, "9.50", None), PLAN_CATALOGUE[1]]
    plans = plan_dimension(spark, odd)
    assert plans.schema.names == DIM_PLAN.names
    first = plans.orderBy("plan_sk").first()
    assert first.plan_name == "It's; \\ \"plan\" {0}" and str(first.base_price_usd) == "9.50"
    assert first.seat_limit is None and plans.count() == 2
