"""The six relational roles and how they are read."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RoleTables:
    """The source tables under canonical column names."""

    enrollment: DataFrame
    student: DataFrame
    course: DataFrame
    interaction: DataFrame
    assessment: DataFrame
    submission: DataFrame

    def changed(self, operator: Callable[[DataFrame], DataFrame]) -> RoleTables:
        """The roles with ``operator`` applied to each table."""
        return RoleTables(
            **{field.name: operator(getattr(self, field.name)) for field in fields(self)}
        )


# Native table and column names of the relational source.
SOURCE_TABLES = {
    "enrollment": "estudiante_curso",
    "student": "estudiante",
    "course": "curso",
    "interaction": "estudiante_recurso",
    "assessment": "asignaciones",
    "submission": "asignacion_estudiante",
}
SOURCE_COLUMNS = {
    "enrollment": {
        "id_estudiante": "id_student",
        "cd_curso": "code_module",
        "cd_semestre": "code_presentation",
        "cant_intentos": "num_of_prev_attempts",
        "cant_creditos": "studied_credits",
        "fecha_registro_dias": "date_registration",
        "resultado_final": "final_result",
    },
    "student": {
        "id_estudiante": "id_student",
        "genero": "gender",
        "region": "region",
        "nivel_educativo": "highest_education",
        "imd_band": "imd_band",
        "tiene_discapacidad": "disability",
        "grupo_edad_inicio": "age_band",
    },
    "course": {
        "cd_curso": "code_module",
        "cd_semestre": "code_presentation",
        "duracion_dias": "course_duration_days",
    },
    "interaction": {
        "id_estudiante": "id_student",
        "cd_curso": "code_module",
        "cd_semestre": "code_presentation",
        "id_recurso": "id_site",
        "fecha_interaccion": "event_day",
        "cant_clicks": "clicks",
    },
    "assessment": {
        "id_asignacion": "id_assessment",
        "cd_curso": "code_module",
        "cd_semestre": "code_presentation",
        "peso_evaluacion": "weight",
    },
    "submission": {
        "id_asignacion": "id_assessment",
        "id_estudiante": "id_student",
        "puntuacion": "score",
    },
}
PARTITION_COLUMNS = {
    "enrollment": "id_estudiante",
    "student": "id_estudiante",
    "interaction": "id_estudiante",
    "submission": "id_estudiante",
}


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns under their canonical names."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def canonical_roles(tables: Mapping[str, DataFrame]) -> RoleTables:
    """Native tables, keyed by native table name, as canonical roles."""
    return RoleTables(
        **{
            role.name: rename(tables[SOURCE_TABLES[role.name]], SOURCE_COLUMNS[role.name])
            for role in fields(RoleTables)
        }
    )


def read_parquet_roles(spark: SparkSession, folder: str) -> RoleTables:
    """Roles from one Parquet dataset per native table."""
    return canonical_roles(
        {name: spark.read.parquet(f"{folder}/{name}") for name in SOURCE_TABLES.values()}
    )


def read_jdbc_roles(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    id_bounds: tuple[int, int],
    partitions: int,
    schema: str = "public",
) -> RoleTables:
    """Roles from a relational database; the large tables are read in id ranges."""
    tables = {}
    for role, table in SOURCE_TABLES.items():
        reader = spark.read.format("jdbc").options(url=url, dbtable=f"{schema}.{table}")
        reader = reader.options(**properties)
        if role in PARTITION_COLUMNS:
            reader = reader.options(
                partitionColumn=PARTITION_COLUMNS[role],
                lowerBound=str(id_bounds[0]),
                upperBound=str(id_bounds[1]),
                numPartitions=str(partitions),
            )
        tables[table] = reader.load()
    return canonical_roles(tables)
