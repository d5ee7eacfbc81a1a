"""What several operators need: written intermediate tables and words of a text."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a text that are cut into words at a time.
CHUNK_BYTES = 1 << 20

_SPACE = re.compile(rb"[ \t-\r]")
_local_folder: str | None = None


class SharedFolderError(RuntimeError):
    """No folder that the driver and all executors share."""


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder; on a cluster
    that is an error, since executors do not see each other's folders.
    """
    global _local_folder
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise SharedFolderError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_folder = _local_folder or tempfile.mkdtemp(prefix="tablewright-llm-")
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tablewright-llm/{app}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Written(NamedTuple):
    """A table written to the shared folder, and where it lies."""

    table: DataFrame
    path: str

    def drop(self) -> None:
        remove(self.table.sparkSession, self.path)


def written(df: DataFrame, name: str) -> Written:
    """Compute the frame once; later reads survive a lost executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return Written(spark.read.schema(df.schema).parquet(path), path)


def word_chunks(
    data: bytes, size: int = CHUNK_BYTES, lower: bool = True
) -> Iterator[list[bytes]]:
    """The words of a text, in lists made from about ``size`` bytes each.

    They are lower-cased in A-Z if wanted. Words are what stands between the bytes 0x20 and 0x09 to 0x0D.
    """
    start, end = 0, len(data)
    while start < end:
        stop = min(start + size, end)
        if stop < end:
            space = _SPACE.search(data, stop)
            stop = space.start() if space else end
        part = data[start:stop]
        words = (part.lower() if lower else part).split()
        if words:
            yield words
        start = stop
