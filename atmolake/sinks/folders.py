"""Folders of tables on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    files, path = _open(spark, path)
    return files.exists(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it; nothing happens if there is none."""
    files, path = _open(spark, path)
    files.delete(path, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    files, source = _open(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def beside(path: str, label: str) -> str:
    """A new name in the folder of `path`, which readers of that folder pass over."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{label}-{name}-{uuid.uuid4().hex}" if folder else f"_{label}-{name}-{uuid.uuid4().hex}"
