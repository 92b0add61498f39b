"""Folders of a store that Spark reaches: listed and deleted through its own file system."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Folder:
    name: str
    size: int
    modified: int
    complete: bool


def _system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def folders(spark: SparkSession, path: str) -> list[Folder]:
    """Folders directly below ``path``: bytes, last change, and whether a finished job wrote them.  None if it does not exist."""
    system, root = _system(spark, path)
    if not system.exists(root):
        return []
    out = []
    for entry in system.listStatus(root):
        if entry.isDirectory():
            here = entry.getPath()
            done = system.exists(spark._jvm.org.apache.hadoop.fs.Path(here, "_SUCCESS"))
            out.append(Folder(here.getName(), system.getContentSummary(here).getLength(), entry.getModificationTime(), done))
    return sorted(out, key=lambda f: f.name)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, in one request."""
    system, root = _system(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(root)) if system.exists(root) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _system(spark, path)
    return system.exists(found)


def modified(spark: SparkSession, path: str) -> int | None:
    system, found = _system(spark, path)
    return system.getFileStatus(found).getModificationTime() if system.exists(found) else None


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that is gone already is no failure."""
    system, found = _system(spark, path)
    system.delete(found, True)
