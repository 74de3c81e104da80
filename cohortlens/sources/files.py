"""Reading the mart, its metadata and the four-table scoring source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlens.contract import MART_SCHEMA
from cohortlens.operators.checks import CheckError, nan_to_null
from cohortlens.operators.scoring import SCORING_TABLES


def read_mart_csv(spark: SparkSession, path: str, schema: T.StructType = MART_SCHEMA) -> DataFrame:
    """The mart from delimited text under an explicit schema.

    Columns are matched by position, so a header in another order is refused.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return nan_to_null(reader.csv(path))


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.schema(MART_SCHEMA).parquet(path))


def read_cutoff(spark: SparkSession, path: str) -> int:
    """The integer ``cutoff_day`` of a metadata record; anything else is refused."""
    # Read as text, so that true, 30.5 and "30" can be told from 30.
    rows = spark.read.text(path, wholetext=True).selectExpr(
        "try_variant_get(parse_json(value), '$.cutoff_day', 'string') AS day",
        "schema_of_variant(variant_get(parse_json(value), '$.cutoff_day')) AS kind",
    ).take(1)
    if not rows or rows[0]["kind"] != "BIGINT":
        raise ValueError(f"{path} records no whole number as cutoff_day")
    return int(rows[0]["day"])


def read_scoring_tables(
    spark: SparkSession, folder: str, file_format: str = "parquet", **options: str
) -> dict[str, DataFrame]:
    """The four scoring tables, each a dataset named like the table."""
    tables, missing = {}, []
    for name in SCORING_TABLES:
        try:
            read = spark.read.format(file_format).options(**options).load(f"{folder}/{name}")
            tables[name] = nan_to_null(read)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            missing.append(name)
    if missing:
        raise CheckError(f"the scoring source lacks the tables {missing}")
    return tables


def read_scoring_catalog(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The four scoring tables of a catalog database."""
    missing = [name for name in SCORING_TABLES if not spark.catalog.tableExists(f"{database}.{name}")]
    if missing:
        raise CheckError(f"the scoring source lacks the tables {missing}")
    return {name: nan_to_null(spark.table(f"{database}.{name}")) for name in SCORING_TABLES}
