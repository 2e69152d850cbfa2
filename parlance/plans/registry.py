"""How queries over the driver's tables are registered, and the units that they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Turns of conversations as utterances, with notation put in by rule. This text is read by both engines.
UNITS_SQL = """
SELECT conv_id AS transcript_id, turn AS tu_id, role AS speaker, start_ms, start_ms + 10 * n + 500 AS end_ms,
       CASE WHEN (conv_id + turn) % 37 = 0 THEN '[]()'
            WHEN (conv_id * 7 + turn) % 10 = 0 THEN replace(replace(replace(text, ' de ', ' [ de] '), '.', ' .'), ' in ', '[ in ]in')
            WHEN (conv_id * 7 + turn) % 10 = 1 THEN '(.) ' || replace(replace(text, ' la ', ' ((ride molto forte)) '), ' of ', '(.)of') || ' (.)'
            WHEN (conv_id * 7 + turn) % 10 = 2 THEN '=' || replace(replace(text, ' the ', ' = '), ' of ', '=of=') || '='
            WHEN (conv_id * 7 + turn) % 10 = 3 THEN replace(replace(replace(text, 'e ', 'è '), ' le ', ' perchè '), ',', '! ,')
            WHEN (conv_id * 7 + turn) % 10 = 4 THEN replace(replace(text, ' en ', ' hm m mha '), ' der ', '=m=') || ' va beh'
            WHEN (conv_id * 7 + turn) % 10 = 5 THEN replace(replace(text, 'the ', ' 23 xxx '), 'la ', '108 ')
            WHEN (conv_id * 7 + turn) % 10 = 6 THEN replace(replace(text, ' un ', ' <un> '), ' and ', '>and ') || ' °piano ° [so(m) < > °'
            WHEN (conv_id * 7 + turn) % 10 = 7 THEN replace(replace(text, ',', ',:'), ' a ', ' A:::h: ') || ' [((ride))] @nome po'':'
            WHEN (conv_id * 7 + turn) % 10 = 8 THEN '# ' || replace(replace(text, ' que ', ' l''albero '), ' die ', ' c(io)è ann- ')
            ELSE '#_ ' || text END AS text
FROM (SELECT conv_id, turn, role, text, CAST(length(text) AS BIGINT) AS n,
             CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 10 AS BIGINT) AS start_ms
      FROM conversations) c
"""


def query(sql: str | None = None):
    """Register a query under its name; `sql` is what DuckDB computes, with {units} for the shared units."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("{units}", f"({UNITS_SQL})")
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task takes, where much is made of each.
ROWS = 200_000


def tasks(rows: DataFrame) -> int:
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS))


def by_size(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to as many tasks as there are rows for, so that a task needs no more memory when there are more. What is made of them by these keys needs no other shuffle; left to the planner, tasks are put together by bytes that are far fewer than what is made of them."""
    return rows.repartition(tasks(rows), *keys)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, those of an order in one task."""
    return by_size(table(spark, sf_dir, "lineitem"), "l_orderkey")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "conversations").createOrReplaceTempView("conversations")
    return spark.sql(UNITS_SQL)


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units(spark, sf_dir).withColumns({"start": F.col("start_ms"), "end": F.col("end_ms")}).drop("start_ms", "end_ms")
