"""Cutting a plan's lineage with tables that survive lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def saved(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the folder that ``spark.checkpoint.dir`` names; where it is unset, a local one if the master is local (tests), else an error."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="tactus-"))
    return df.checkpoint()
