"""Shared storage of a run: the folder that the cluster names, and written tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, a local session sets a folder of its own once, and a cluster is an error:
    its machines share no temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="shared_")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _filesystem(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed when the driver's JVM ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    hfs, hpath = _filesystem(spark, path)
    hfs.mkdirs(hpath)
    hfs.deleteOnExit(hpath)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends here, and a lost executor costs no rerun of what came before."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path + "/t")
    out = spark.read.schema(df.schema).parquet(path + "/t")
    out._written_to = path
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more."""
    hfs, hpath = _filesystem(spark, path)
    hfs.delete(hpath, True)


def dropped(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more."""
    for df in tables:
        removed(df.sparkSession, df._written_to)


def renamed(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str], list[str]]:
    """``docs`` under column names that nothing added can clash with; the new names of all columns and of ``columns``."""
    names = [f"own_{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names, [names[docs.columns.index(c)] for c in columns]
