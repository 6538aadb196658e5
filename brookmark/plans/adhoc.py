"""Bounded read-only queries."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MAX_ROWS = 100
_OPENING = re.compile(r"(\s|--[^\n]*(\n|$)|/\*.*?\*/)*(select|with)\b", re.IGNORECASE | re.DOTALL)


def _single_query(text: str) -> str:
    body = text.strip()
    while body.endswith(";"):
        body = body[:-1].rstrip()
    if not _OPENING.match(body):
        raise ValueError("only a single SELECT (or WITH ... SELECT) statement is allowed")
    return body


@dataclass(frozen=True)
class Answer:
    rows: DataFrame
    truncated: bool


def safe_sql(spark: SparkSession, text: str, limit: int = MAX_ROWS) -> DataFrame:
    """At most ``limit`` rows of one SELECT (or WITH ... SELECT) statement.

    The text is embedded as a subquery, so Spark's own grammar turns away anything that is not a
    single query: commands, DML after WITH, and a second statement. A trailing semicolon is fine.
    """
    body = _single_query(text)
    return spark.sql(f"SELECT * FROM (\n{body}\n) AS bounded LIMIT {int(limit)}")


def bounded_query(spark: SparkSession, text: str, limit: int = MAX_ROWS) -> Answer:
    """Result of a query cut at ``limit`` rows, and whether there were more; the query runs once.

    One row beyond the limit tells whether there are more; so few rows are held by the driver.
    """
    cut = safe_sql(spark, text, limit + 1)
    held = cut.toArrow()
    return Answer(spark.createDataFrame(held.slice(0, limit), cut.schema), held.num_rows > limit)


def row_count(spark: SparkSession, text: str) -> int:
    """True number of rows of a query; a separate call, because it runs the whole query."""
    body = _single_query(text)
    return spark.sql(f"SELECT count(*) FROM (\n{body}\n) AS counted").first()[0]
