"""Moving finished files into place, through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none where it does not exist."""
    store, place = _at(spark, path)
    return sorted(status.getPath().getName() for status in store.listStatus(place)) if store.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished file or folder its name: one step of the file system, so nobody sees half of it."""
    store, place = _at(spark, source)
    goal = _at(spark, target)[1]
    store.mkdirs(goal.getParent())
    if store.exists(goal) or not store.rename(place, goal):
        raise FileExistsError(f"{source} could not become {target}")


def remove(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)
