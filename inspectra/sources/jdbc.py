"""Database tables and parameterised queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, split_by: str | None = None, bounds: tuple | None = None, connections: int = 8, fetch_rows: int = 10_000, **options: str) -> DataFrame:
    """A table of a database; filters and columns reach it.

    With ``split_by`` (a number, date or timestamp) and its ``bounds`` the table is
    read in ranges by at most ``connections`` at once; the bounds set the width of
    the ranges only, and rows beyond them or with null come too. Without, one
    connection reads it all. Further options (driver, user) go to the reader.
    """
    if (split_by is None) != (bounds is None):
        raise ValueError("split_by and bounds belong together")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch_rows), **options)
    if split_by is not None:
        low, high = bounds
        reader = reader.options(partitionColumn=split_by, lowerBound=str(low), upperBound=str(high), numPartitions=str(connections))
    return reader.load()


def rows(spark: SparkSession, sql: str, most: int = 10_000, **params) -> list[dict]:
    """A query's rows as dicts, for display. ``:name`` in the query takes a value
    that is bound, never pasted in; more than ``most`` rows raise ValueError."""
    got = spark.sql(sql, args=params).limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows")
    return [r.asDict(recursive=True) for r in got]
