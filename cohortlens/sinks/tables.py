"""Writing artifacts, profile tables and predictions."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from posixpath import normpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortlens.contract import ARTIFACTS, KEYS, TARGETS
from cohortlens.models.legacy import ModelRun, metrics_summary
from cohortlens.operators.checks import reject_banned_columns, require_columns, validate_mart
from cohortlens.operators.mart import artifact_metadata, artifact_tables

METADATA = "training_metadata"


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(file_format).save(path)
    return path


def read_table(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet"
) -> DataFrame:
    """A table that ``write_table`` wrote."""
    reader = spark.read.schema(schema)
    if file_format == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(file_format).load(path)


def write_artifacts(
    mart: DataFrame,
    folder: str,
    cutoff_day: int,
    file_format: str = "parquet",
    generated_at: datetime | None = None,
) -> dict[str, str]:
    """Write full, features and targets tables sorted by key, then the metadata record.

    The full table is written first and checked as read back, and the others are cut
    from it, so the mart is computed once. Metadata are written last and only for a
    table that passed.
    """
    spark = mart.sparkSession
    require_columns(mart, (*KEYS, *TARGETS), "training mart")
    reject_banned_columns(mart, "training mart")
    paths = {name: f"{folder}/{table}" for name, table in ARTIFACTS.items()}
    ordered = artifact_tables(mart)["full"].orderBy(*KEYS)
    write_table(ordered, paths["full"], file_format)
    full = read_table(spark, paths["full"], ordered.schema, file_format)
    validate_mart(full)
    for name, table in artifact_tables(full).items():
        if name != "full":
            write_table(table.orderBy(*KEYS), paths[name], file_format)
    paths["metadata"] = f"{folder}/{METADATA}"
    metadata = artifact_metadata(full, cutoff_day, generated_at)
    metadata.coalesce(1).write.mode("overwrite").json(paths["metadata"])
    return paths


def write_profile(
    tables: Mapping[str, DataFrame], folder: str, file_format: str = "parquet"
) -> dict[str, str]:
    return {
        name: write_table(table, f"{folder}/{name}", file_format) for name, table in tables.items()
    }


def _location(path: str) -> str:
    """Path without scheme or trailing slash, for telling two paths apart."""
    _, _, rest = path.rpartition("://") if "://" in path else ("", "", path.removeprefix("file:"))
    return normpath(rest)


def write_predictions(
    predictions: DataFrame, path: str, source: str, file_format: str = "csv"
) -> str:
    """Write predictions anywhere but into the source they come from."""
    target, origin = _location(path), _location(source)
    if target == origin or origin.startswith(f"{target}/") or target.startswith(f"{origin}/"):
        raise ValueError("prediction output must not overwrite the scoring source")
    return write_table(predictions.orderBy(*KEYS), path, file_format)


def write_legacy(runs: Mapping[str, ModelRun], folder: str) -> dict[str, str]:
    """Test predictions by type and model, and one metrics summary."""
    paths = {}
    for name, run in runs.items():
        if name == "unsupervised":
            continue
        path = f"{folder}/predictions/{name}"
        run.predictions.write.mode("overwrite").partitionBy("type", "model").parquet(path)
        paths[name] = path
    paths["metrics_summary"] = write_table(metrics_summary(runs), f"{folder}/metrics_summary")
    return paths
