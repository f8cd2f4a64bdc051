"""Working folders that every executor can reach."""

from __future__ import annotations

import io
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``; without one the
    checkpoint folder set on the context is used.  There is no local fallback.
    What an application writes here is deleted when it ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = f"{base.rstrip('/')}/claimflow/{spark.sparkContext.applicationId}"
    _delete_at_exit(spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


@cache
def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whatever storage; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name on the same storage; the name must be free."""
    place, goal = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(to)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).rename(place, goal):
        raise OSError(f"{path} could not be renamed to {to}")


_scopes = threading.local()


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside are deleted when the block is left.

    What is read from later on has to be stored with ``keep=True``; it then belongs to
    the block around this one, if there is one, and else to the application.
    """
    stack: list[list[str]] = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            delete_path(spark, path)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write to shared storage and read back: a cut lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    stack = _scopes.__dict__.get("stack", [])
    if len(stack) > keep:
        stack[-1 - keep].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipping = threading.Lock()
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, which need not find it on a path of their own."""
    with _shipping:
        if spark.sparkContext.applicationId in _shipped:
            return
        package = Path(__file__).resolve().parents[1]
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        path = scratch_path(spark, "package") + ".zip"
        files, place = fs.FileSystem.from_uri(path)
        with files.open_output_stream(place) as out:
            out.write(held.getvalue())
        spark.sparkContext.addPyFile(path)
        _shipped.add(spark.sparkContext.applicationId)
