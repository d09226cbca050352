"""SQL query results over JDBC; the database runs the query."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from tabwright.config import SourceSpec


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    """Reader options of a source: a query, or a table that may be read in ranges.

    A range read needs ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    in the options; Spark allows it for a table, not for a query.
    """
    if not spec.url:
        raise ValueError("a database source needs a JDBC url")
    if bool(spec.query) == bool(spec.table):
        raise ValueError("a database source needs either a query or a table")
    options = {"url": spec.url, **spec.options}
    options["query" if spec.query else "dbtable"] = spec.query or spec.table
    if spec.driver:
        options["driver"] = spec.driver
    ranged = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} & set(options)
    if spec.query and "partitionColumn" in ranged:
        options["dbtable"] = f"({options.pop('query')}) source_query"
    return options


def sqlite_url(path: str) -> str:
    return f"jdbc:sqlite:{path}"


def jdbc_reader(spark: SparkSession, spec: SourceSpec) -> DataFrameReader:
    return spark.read.format("jdbc").options(**jdbc_options(spec))


def read_jdbc(spark: SparkSession, url: str, query: str, driver: str | None = None,
              **options: str) -> DataFrame:
    return jdbc_reader(spark, SourceSpec(kind="database", url=url, query=query, driver=driver,
                                         options=options)).load()
