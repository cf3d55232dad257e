"""Small files on whatever file system a path names: lists of folders and markers. Data goes through Spark."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    system, target = _system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    system, target = _system(spark, path)
    system.delete(target, True)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Replaces a file. It is written beside its place and renamed, so readers see all of it or none."""
    system, target = _system(spark, path)
    _, beside = _system(spark, f"{path}.tmp")
    system.mkdirs(target.getParent())
    out = system.create(beside, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if not system.rename(beside, target):  # some file systems do not replace by renaming
        system.delete(target, False)
        if not system.rename(beside, target):
            raise OSError(f"{path} could not be written")


def read_json(spark: SparkSession, path: str):
    """The value of a file; None if it is not there."""
    system, target = _system(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def numbered(spark: SparkSession, path: str) -> list[int]:
    """The numbers that name the JSON files of a folder."""
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, path) if n.endswith(".json"))


def read_folders(spark: SparkSession, paths: Iterable[str], schema: T.StructType, base: str | None = None) -> DataFrame:
    """The rows of some folders; none of no folders. `base`: where the names of partition columns begin."""
    paths = list(paths)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return (reader.option("basePath", base) if base else reader).parquet(*paths)
