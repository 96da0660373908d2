"""Folders of partitioned tables, through the file system that the path names."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path``, in order; none if there is no such path."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def partition_folders(spark: SparkSession, path: str, by: str) -> dict[str, str]:
    """The values of partition column ``by`` under ``path``, with their folders' names."""
    start = f"{by}="
    folders = [f for f in child_folders(spark, path) if f.startswith(start)]
    return {unquote(f[len(start) :]): f for f in folders}


def delete_folder(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)
