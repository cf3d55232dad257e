"""The shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. It has to be set; only a session whose tasks all run
    in the driver's own process, as in tests, gets a folder of its own, which goes with the process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="hydrolens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class RunFolder:
    """A new folder for the intermediate tables of one run, removed by `close` (or at the end of a `with`
    block), at the latest when the session's JVM ends.

    A frame used several times is written once and read back. The files outlive executors,
    the lineage is cut, and the planner knows the true size of what it joins.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)

    def __enter__(self) -> RunFolder:
        return self

    def __exit__(self, *failure: object) -> None:
        self.close()

    def close(self) -> None:
        """Removes the folder. Frames read from it can not be used any more."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        system.delete(path, True)
        system.cancelDeleteOnExit(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
