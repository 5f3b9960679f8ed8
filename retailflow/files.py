"""Folder operations on whatever file system a path names, through Hadoop's FileSystem."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _open(spark, path)
    return system.exists(location)


def create_folder(spark: SparkSession, path: str) -> None:
    system, location = _open(spark, path)
    system.mkdirs(location)


def create_marker(spark: SparkSession, path: str) -> bool:
    """An empty file, there or not there: the atomic step that publishes a write.

    False if it was there before.
    """
    system, location = _open(spark, path)
    return system.createNewFile(location)


def claim(spark: SparkSession, path: str, owner: str) -> str:
    """Make the file ``path`` that says ``owner``, if there is none; what it says then.

    The file is written under a name of its own and renamed, which fails where the name is
    taken: of several claims at once, one file stays.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    system, location = _open(spark, path)
    _, own = _open(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(own, False)
    stream.write(bytearray(owner.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    never = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(own, location, never)
        return owner
    except Py4JJavaError as error:
        system.delete(own, False)
        if not system.exists(location):
            raise error
    stream = system.open(location)
    said = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return said


def names(spark: SparkSession, path: str) -> list[str]:
    system, location = _open(spark, path)
    if not system.exists(location):
        return []
    return [status.getPath().getName() for status in system.listStatus(location)]


def matches(spark: SparkSession, pattern: str) -> list[str]:
    system, location = _open(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(location) or []]


def move(spark: SparkSession, source: str, target: str) -> None:
    system, start = _open(spark, source)
    _, end = _open(spark, target)
    if not system.rename(start, end):
        raise OSError(f"cannot move {source} to {target}")


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The files directly in a folder."""
    system, location = _open(spark, path)
    return [s.getPath().toString() for s in system.listStatus(location) if s.isFile()]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    system, location = _open(spark, path)
    return system.getContentSummary(location).getLength()


def set_modified(spark: SparkSession, path: str, milliseconds: int) -> None:
    system, location = _open(spark, path)
    system.setTimes(location, milliseconds, -1)


def delete(spark: SparkSession, path: str) -> None:
    system, location = _open(spark, path)
    system.delete(location, True)
