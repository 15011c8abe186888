"""Places for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for a table: in the folder that the cluster shares, ``spark.checkpoint.dir``.

    Only a local master, as in tests, may do without that setting; then a temporary folder of this machine serves.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.conf.get("spark.master")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="statewise-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"
