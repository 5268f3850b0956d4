"""Small files on any file system Spark reaches: commit records and folder names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place = _place(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all.

    An existing file stays as it is, whoever wrote it.
    """
    system, place = _place(spark, path)
    if system.exists(place):
        return
    hidden = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}.writing")
    stream = system.create(hidden, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(hidden, place) and not system.exists(place):
        raise OSError(f"could not put {path} in place")


def delete(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
