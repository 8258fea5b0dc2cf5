"""Where tables that a query writes and reads again go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from strandlake.schema import AnnotationError


def new_folder(spark: SparkSession, name: str) -> str:
    """A new place in the session's spark.checkpoint.dir; in a temporary folder where that is unset and all runs on one
    machine. On a cluster it must be set. What is written there stays, as results read it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise AnnotationError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="strandlake-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
