"""Shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and the master is local, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/clickloom-{purpose}-{uuid.uuid4().hex}"
