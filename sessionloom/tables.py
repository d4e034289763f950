"""Access to the tables of a data directory and to the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """The table ``name``; with ``columns``, only these (pruned in the scan)."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*[F.col(c) for c in columns]) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where a local master names none (tests on one machine) a temporary folder is set; a cluster must name one, as
    a folder of one machine would hold a part of each table.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set; intermediate tables need a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='sessionloom-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def work_dir(spark: SparkSession) -> str:
    """The application's folder within the shared one; Hadoop deletes it when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/sessionloom-{spark.sparkContext.applicationId}"
    if getattr(spark.sparkContext, "_sessionloom_work", None) != path:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(place)
        system.deleteOnExit(place)
        spark.sparkContext._sessionloom_work = path
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder as Parquet and read it back.

    The files outlive lost executors; unlike a checkpoint they keep column statistics and pruning. They go with the application.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
