"""Profiles that add up: measures of a table, one row a file, kept so that a later check reads new files only.

A profile row holds counts, and first and last values, of one file. Rows add up to the measures of the whole table, so a table
to which files were added, or of which some were replaced, is measured by reading these files alone. A file is told by
path, size and time of change; rows of files that are gone or were changed since match nothing and are left where they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.warehouse import settle

_FILE = {"__arquivo": "file_path", "__tamanho": "file_size", "__alterado": "file_modification_time"}
#: Files that are picked by their names in the scan; of more, all are read and those with a profile dropped.
NAMED_FILES = 1 << 14


@dataclass(frozen=True)
class Measure:
    """A whole number over rows, and how those of two files become one: ``sum``, ``min`` or ``max``."""

    over_rows: Column
    merge: str = "sum"


def _file() -> list[Column]:
    return [F.col(f"_metadata.{field}").alias(name) for name, field in _FILE.items()]


def _schema(measures: Mapping[str, Measure]) -> T.StructType:
    fields = [T.StructField("__arquivo", T.StringType()), T.StructField("__tamanho", T.LongType()), T.StructField("__alterado", T.TimestampType())]
    return T.StructType([*fields, *[T.StructField(name, T.LongType()) for name in measures]])


def files_of(table: DataFrame) -> DataFrame:
    """The files with rows of a plain scan, with size and time of change; no column of the rows is read."""
    return table.select(*_file()).distinct()


def profile(table: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """One row a file: its path, size and time of change, and the measures of its rows.

    Tasks add their rows up, so one row a file and task is moved.
    """
    values = [F.coalesce(m.over_rows.cast("bigint"), F.lit(0) if m.merge == "sum" else F.lit(None)).alias(name) for name, m in measures.items()]
    names = list(_FILE)
    return table.select("*", *_file()).groupBy(*names).agg(*values)


def _known(table: DataFrame, folder: str, measures: Mapping[str, Measure]) -> DataFrame:
    spark, schema = table.sparkSession, _schema(measures)
    try:
        stored = spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    if set(schema.names) - set(stored.columns):
        raise ValueError(f"the profiles in {folder} are of other measures; give each set of measures a folder of its own")
    return stored.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def kept_profiles(table: DataFrame, folder: str, measures: Mapping[str, Measure]) -> DataFrame:
    """The profile of every file of ``table``, read from ``folder`` or else made now and appended there.

    ``table`` must be a plain scan. Only files without a profile are read; of the others Spark reads the footers. A file is
    profiled once if calls follow one another; calls side by side may both append it, which changes no result.
    """
    names = list(_FILE)
    present = settle(files_of(table), "files")
    known = _known(table, folder, measures)
    new = present.join(known.select(*names), names, "left_anti")
    paths = [r[0] for r in new.select("__arquivo").limit(NAMED_FILES + 1).collect()]
    if paths:
        if len(paths) <= NAMED_FILES:
            made = profile(table.where(F.col("_metadata.file_path").isin(paths)), measures)
        else:
            made = profile(table, measures).join(settle(new, "new_files"), names, "left_semi")
        # Written apart first, as the folder is read for it.
        settle(made, "profiles").write.mode("append").parquet(folder)
        # The listing made for the first reading does not know the new files.
        known = _known(table, folder, measures)
    return known.join(present, names, "left_semi").dropDuplicates(names)


def merged(profiles: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """One row: the measures of all files together. A table without rows has sums of 0 and no first or last value."""
    parts = []
    for name, measure in measures.items():
        value = getattr(F, measure.merge)(F.col(f"`{name}`"))
        parts.append((F.coalesce(value, F.lit(0)) if measure.merge == "sum" else value).cast("bigint").alias(name))
    return profiles.agg(*parts)
