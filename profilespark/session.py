"""Where intermediate tables go: the folder the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir, or below the warehouse where that is unset.

    Both are storage that driver and executors share. Spark removes the folder when the application ends.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    folder = f"{base.rstrip('/')}/{sc.applicationId}"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not store.exists(path):
        store.mkdirs(path)
        store.deleteOnExit(path)
    return store.makeQualified(path).toString()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors and computes the plan once, with
    column and partition pruning for whoever reads it next.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
