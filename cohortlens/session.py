"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Recording a call site per column makes building plans several times slower.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, intermediate tables go below the warehouse
    folder; a cluster whose warehouse is a machine's own disk is refused, as its
    tables would be lost with the machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    folder = spark.conf.get("spark.sql.warehouse.dir")
    own_disk = folder.startswith(("file:", "/"))
    if own_disk and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cohortlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, removed by ``release``."""
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Fixes row placement (partition numbers, row positions) so that later
    branches and recomputed tasks all see the same values, and cuts lineage.
    All tables of one application lie in one folder, removed by ``release``.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the application's intermediate tables; call it once its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
