"""Whole-history runs whose tables readers never see half done.

A run writes all its tables under a folder of its own. When it is through, the views of the session's catalog are pointed to them,
each in one step. Readers name views; a run that fails leaves the views, and so all readers, on the last whole run, whose
files are not touched.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import SparkSession

from turnstile.config import REPORTS, Settings
from turnstile.plans import jobs
from turnstile.sinks import write_table
from turnstile.sources import read_if_there

RUNS = "run INT, root STRING"
GRAPH = ("v_student", "v_event", "v_library", "v_room", "e_performed", "e_at_library", "e_in_room", "e_entered", "e_studied_in")


def run_settings(settings: Settings, run: int) -> Settings:
    """The settings of one run: its outputs in a folder of their own, its inputs where they are."""
    inputs = {name: settings.path(name) for name in ("raw", "curated", "students")}
    return replace(settings, root=settings.path(f"runs/{run:06d}"), paths={**settings.paths, **inputs})


def finished_runs(spark: SparkSession, settings: Settings) -> dict[int, str]:
    """The folders of the runs that went through: one row a run."""
    return dict(map(tuple, read_if_there(spark, settings.path("runs/finished"), RUNS).collect()))


def tables(settings: Settings) -> dict[str, str]:
    """View names and the folders of a run's tables."""
    named = {f"report_{name}": settings.report(name) for name in REPORTS}
    return {"clean": settings.clean} | named | {name: settings.graph(name) for name in GRAPH}


def publish(spark: SparkSession, settings: Settings, database: str) -> None:
    """Point the views of ``database`` to the tables of ``settings``. A table of no rows has no file to take a schema from and
    keeps the view as an empty one, if there is one."""
    if not re.fullmatch(r"\w+", database):
        raise ValueError(f"not a database name: {database!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in tables(settings).items():
        where = path.replace("`", "``")
        if spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).isEmpty():
            if spark.catalog.tableExists(f"{database}.{name}"):
                columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in spark.table(f"{database}.{name}").schema)
                spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} WHERE false")
        else:
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{where}`")


def run_versioned(spark: SparkSession, settings: Settings, database: str, as_of=None) -> int:
    """A whole-history run in a new folder, published when it is through; the run's number."""
    run = 1 + max(finished_runs(spark, settings), default=0)
    new = run_settings(settings, run)  # a folder that a failed run left is overwritten table by table
    jobs.run_full_batch(spark, new, as_of=as_of)
    write_table(spark.createDataFrame([(run, new.root)], RUNS), settings.path("runs/finished"), mode="append")
    publish(spark, new, database)
    return run
