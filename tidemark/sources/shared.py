"""Tables that a job writes for its own later steps, in the folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in spark.checkpoint.dir that isn't there yet; where none is set, below a new local folder, on one machine only (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
