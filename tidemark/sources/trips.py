"""Reading trip files."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.schemas import TRIP_EVENT
from tidemark.sources.drift import Group, file_groups, is_conflict, lost_values, read_groups

# Fixed value: trip files share a folder with other files and are told apart by name.
TRIP_FILES = "yellow_tripdata_*.parquet"


def read_trips(spark: SparkSession, path: str, pattern: str = TRIP_FILES,
               schema: T.StructType | None = None) -> DataFrame:
    """All trip files below ``path``; refuses a missing folder, no matching file and files without rows.

    The schema is that of all files together unless given; a given one saves looking into the files. A column that a
    file lacks is NULL in its rows. Columns whose type differs between files come in the type that a trip record has,
    others than those as text; values that do not convert are NULL, see :func:`unreadable_values`.
    """
    try:
        trips = _all_files(spark, path, pattern, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"trip folder missing: {path}") from error
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise FileNotFoundError(f"no files like {pattern} under {path}") from error
        raise
    if trips.isEmpty():
        raise ValueError(f"no rows in the trip files under {path}")
    return trips


def _all_files(spark: SparkSession, path: str, pattern: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern).option("mergeSchema", True)
    if schema:
        return reader.schema(schema).parquet(path)
    try:
        return reader.parquet(path)
    except Exception as error:  # Spark reports a conflict as one of several classes
        if not is_conflict(error):
            raise
    groups, base = _groups(spark, path, pattern)
    return read_groups(spark, groups, base, TRIP_EVENT)


def _groups(spark: SparkSession, path: str, pattern: str) -> tuple[list[Group], str]:
    # Listing the files needs a schema, but no look into them.
    listed = list(spark.read.schema("listed string").option("pathGlobFilter", pattern).parquet(path).inputFiles())
    base = path if len(listed) > 1 else os.path.dirname(listed[0])  # the path may be the file itself
    return file_groups(spark, listed, base), base


def unreadable_values(spark: SparkSession, path: str, pattern: str = TRIP_FILES) -> DataFrame:
    """Values of drifting columns that :func:`read_trips` gives as NULL: per file and column, how many and an example."""
    groups, base = _groups(spark, path, pattern)
    return lost_values(spark, groups, base, TRIP_EVENT)
