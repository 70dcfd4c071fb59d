"""Intermediate tables that leave no shuffle files behind."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.tables import cut_lineage

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and go on from there; Spark then drops its shuffle files.

    What is lost with an executor is computed again while the table is written, and is in the
    shared folder afterwards.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return cut_lineage(df)
    finally:
        conf.set(_CLEANUP, before)
