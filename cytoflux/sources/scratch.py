"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir, else a temporary folder (local runs only)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="cytoflux-checkpoint-"))
    return sc.getCheckpointDir()


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    folder = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def cut(df: DataFrame) -> DataFrame:
    """df, written as a table to the shared folder, so that later passes reread instead of recompute."""
    return _write(df)[0]


class Scratch:
    """Tables like those of `cut` that a result doesn't read: a `with` block drops them at its end, or `drop` before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def cut(self, df: DataFrame) -> DataFrame:
        table, folder = _write(df)
        self.folders.append(folder)
        return table

    def drop(self) -> None:
        sc = self.spark.sparkContext
        while self.folders:
            path = sc._jvm.org.apache.hadoop.fs.Path(self.folders.pop())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()
