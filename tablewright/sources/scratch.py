"""A place for files that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder named in ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder; on a cluster executors
    need a folder they share, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tablewright-")
    return f"{root.rstrip('/')}/tablewright-{uuid.uuid4().hex}/{name}"
