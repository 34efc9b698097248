"""Batch file sources. Explicit schemas everywhere: no inference pass over the data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.schema import CLEAN_EVENT, EVENT_COLUMNS, GATE_EVENT, STUDENT_CSV


def read_students_csv(spark: SparkSession, path: str, unread: bool = False) -> DataFrame:
    """Student dimension file ``student_id,major,year_of_study,study_level`` (all text). ``unread`` adds the column
    ``unread``: the whole line where it has too few or too many fields, else null."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if not unread:
        return reader.schema(STUDENT_CSV).csv(path)
    schema = T.StructType([*STUDENT_CSV.fields, T.StructField("unread", T.StringType(), True)])
    # Without pruning: else fields that a query does not use are not counted.
    return reader.schema(schema).option("columnNameOfCorruptRecord", "unread").option("columnPruning", False).csv(path)


def read_events_json(
    spark: SparkSession, path: str, schema: T.StructType = GATE_EVENT, lines: bool = False
) -> DataFrame:
    """An event batch file: one (indented) JSON array of event objects per file, which one task must read
    whole. ``lines``: JSON Lines, one event a line, which Spark splits; use it for large files."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_table(spark: SparkSession, path: str, empty: T.StructType) -> DataFrame:
    """A Parquet table; a folder without a file yet is a table without rows, of the ``empty`` schema."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as none:
        if none.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(empty).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table read with ``schema``, or no rows if there is no such folder yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as none:
        if none.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def partitions(spark: SparkSession, path: str, columns: str, days: list | None = None) -> list[tuple]:
    """The distinct values of a table's partition columns (``columns``: name and type of each, the day first), from its
    directories: no file is opened. ``days`` restricts them.

    A session of its own asks the metadata-only question (a distinct over partition columns), so that the caller's settings
    stay. One tuple a directory reaches the driver. A directory whose files have no rows counts, too.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.optimizer.metadataOnly", "true")
    table = read_if_there(listing, path, columns).select(*T.StructType.fromDDL(columns).fieldNames())
    if days is not None:
        table = table.filter(F.col(table.columns[0]).isin(days))
    return [tuple(r) for r in table.distinct().collect()]


def partition_days(spark: SparkSession, path: str, column: str = "record_date") -> list:
    """The days under which a table has directories, newest first; ``column`` is its first partition column."""
    return sorted({day for (day,) in partitions(spark, path, f"{column} DATE") if day is not None}, reverse=True)


def latest_partition(spark: SparkSession, path: str, schema: T.StructType | str, column: str = "record_date"):
    """The newest day that has rows, None for no rows. Directories are tried from the newest on; of each one row is
    read at most."""
    table = read_if_there(spark, path, schema)
    for day in partition_days(spark, path, column):
        if not table.filter(F.col(column) == F.lit(day)).select(F.lit(1)).isEmpty():
            return day
    return None


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated event table (Parquet, hive-partitioned).

    Columns are selected by name so a partition column (which discovery moves to the end)
    keeps its place; filters on ``gate_type`` / ``record_date`` prune directories.
    """
    df = read_table(spark, path, CLEAN_EVENT)
    ordered = [c for c in EVENT_COLUMNS if c in df.columns]
    rest = [c for c in df.columns if c not in ordered]
    return df.select(*ordered, *rest)


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """The raw append log: one JSON payload per line in column ``value``."""
    return spark.read.text(path)
