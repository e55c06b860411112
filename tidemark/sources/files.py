"""Reading files and tables that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_present(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet data at ``path``, or None when nothing was written there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return None
        raise


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was completed: Spark then leaves an empty file of this name."""
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; returns whether it was there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none when it is not there."""
    return _names(spark, path, folder=True)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, sorted; none when it is not there."""
    return _names(spark, path, folder=False)


def _names(spark: SparkSession, path: str, folder: bool) -> list[str]:
    parent = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(parent):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(parent) if found.isDirectory() == folder)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A lookup table that has to be there."""
    found = read_if_present(spark, path)
    if found is None:
        raise FileNotFoundError(f"missing lookup: {path}")
    return found


def read_source_table(spark: SparkSession, table: str, **jdbc: str) -> DataFrame:
    """The table a mirror is checked against: a catalog table, or a JDBC one when options are given."""
    if not jdbc:
        return spark.table(table)
    return spark.read.format("jdbc").options(dbtable=table, **jdbc).load()
