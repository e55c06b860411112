"""Files whose columns changed their type from one delivery to the next, read as one table.

Parquet has no rule for a column that is a bigint in one file and a double or text in another. Files are put in groups
of one schema each; a group is read as it is, its drifting columns are converted to the wanted type, and the groups are
united. A value converts if nothing of it is lost; others become NULL and can be listed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.values import as_timestamp

# What Spark calls files that it cannot read as one table.
_CONFLICT = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def is_conflict(error: Exception) -> bool:
    return any(name in str(error) for name in _CONFLICT)


@dataclass(frozen=True)
class Group:
    """Files of one schema. Columns that some of the files lack are in it all the same."""

    schema: T.StructType
    files: list[str]

    @property
    def types(self) -> dict[str, T.DataType]:
        """Type of each column, by the name in lower case: case does not tell columns apart."""
        return {f.name.lower(): f.dataType for f in self.schema}


def file_groups(spark: SparkSession, files: list[str], base: str) -> list[Group]:
    """The files in groups that Spark can read together, in the order of their names.

    Spark reads the footers of many files in parallel and merges them. Where that fails the files are halved. Types
    change with time and so do file names, so few halvings find each change; groups next to each other that agree are
    joined again.
    """
    found = _halved(spark, sorted(files), base)
    joined: list[Group] = []
    for group in found:
        if joined and _agree(joined[-1], group):
            known = joined[-1]
            added = [f for f in group.schema if f.name.lower() not in known.types]
            joined[-1] = Group(T.StructType([*known.schema, *added]), known.files + group.files)
        else:
            joined.append(group)
    return joined


def _halved(spark: SparkSession, files: list[str], base: str) -> list[Group]:
    try:
        schema = spark.read.option("mergeSchema", True).option("basePath", base).parquet(*files).schema
        return [Group(schema, files)]
    except Exception as error:  # Spark reports a conflict as one of several classes
        if len(files) == 1 or not is_conflict(error):
            raise
    half = len(files) // 2
    return _halved(spark, files[:half], base) + _halved(spark, files[half:], base)


def _agree(a: Group, b: Group) -> bool:
    return all(b.types.get(name, kind) == kind for name, kind in a.types.items())


def converted(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """The value in the wanted type if it is exactly that value there, else NULL.

    Text of a whole number may have a fraction of zeros, as a column that once was a double leaves it.
    """
    if given == wanted:
        return value
    if isinstance(wanted, T.TimestampType):
        return as_timestamp(value, given)
    if isinstance(wanted, T.StringType):
        return value.cast("string")
    if isinstance(given, T.StringType):
        if isinstance(wanted, T.IntegralType):
            number = value.try_cast("decimal(38,18)")
            return F.when(number == F.floor(number), number.try_cast(wanted))
        return value.try_cast(wanted)
    cast = value.try_cast(wanted)
    return F.when(cast.try_cast(given) == value, cast)


def drifting(groups: list[Group], declared: T.StructType) -> dict[str, T.DataType]:
    """Columns that have different types in different groups, and what they become: the declared type, text without one."""
    wanted = {f.name.lower(): f.dataType for f in declared}
    kinds: dict[str, list[T.DataType]] = {}
    for group in groups:
        for name, kind in group.types.items():
            known = kinds.setdefault(name, [])
            if kind not in known:
                known.append(kind)
    return {name: wanted.get(name, T.StringType()) for name, known in kinds.items() if len(known) > 1}


def _names(groups: list[Group], declared: T.StructType) -> dict[str, str]:
    """How each column is spelled in the end: as declared, else as the first group has it."""
    names = {f.name.lower(): f.name for f in declared}
    for group in groups:
        for field in group.schema:
            names.setdefault(field.name.lower(), field.name)
    return names


def _read(spark: SparkSession, group: Group, base: str) -> DataFrame:
    return spark.read.schema(group.schema).option("basePath", base).parquet(*group.files)


def read_groups(spark: SparkSession, groups: list[Group], base: str, declared: T.StructType) -> DataFrame:
    """All files as one table; a column that a file lacks is NULL in its rows."""
    becomes, names = drifting(groups, declared), _names(groups, declared)

    def columns(group: Group) -> list[Column]:
        return [(converted(F.col(f"`{f.name}`"), f.dataType, becomes[f.name.lower()]) if f.name.lower() in becomes
                 else F.col(f"`{f.name}`")).alias(names[f.name.lower()]) for f in group.schema]

    frames = [_read(spark, group, base).select(*columns(group)) for group in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


_LOST = "file string, column string, given string, wanted string, rows bigint, example string"


def lost_values(spark: SparkSession, groups: list[Group], base: str, declared: T.StructType) -> DataFrame:
    """Per file and drifting column: values that do not convert, how many rows and the least of them as text.

    Groups whose columns all have their wanted type already are not read.
    """
    becomes, frames = drifting(groups, declared), []
    for group in groups:
        checks = []
        for field in group.schema:
            wanted = becomes.get(field.name.lower(), field.dataType)
            if field.dataType != wanted:
                value = F.col(f"`{field.name}`")
                bad = value.isNotNull() & converted(value, field.dataType, wanted).isNull()
                checks.append(F.when(bad, F.struct(
                    F.lit(field.name.lower()).alias("column"), F.lit(field.dataType.simpleString()).alias("given"),
                    F.lit(wanted.simpleString()).alias("wanted"), value.cast("string").alias("value"))))
        if checks:
            rows = _read(spark, group, base).select(F.col("_metadata.file_name").alias("file"),
                                                    F.explode(F.array_compact(F.array(*checks))).alias("lost"))
            frames.append(rows.groupBy("file", "lost.column", "lost.given", "lost.wanted")
                          .agg(F.count(F.lit(1)).alias("rows"), F.min("lost.value").alias("example")))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], _LOST)
