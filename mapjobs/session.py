"""Session helpers shared by the jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share.

    It is the folder named in ``spark.checkpoint.dir``. Where that is unset (as in tests), a
    folder inside the warehouse is used and set as the checkpoint folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder; its lineage ends there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and reread: its size is known, and nothing of how it was partitioned stays."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast: Spark guesses its size from compressed files, and rows with tags take many times that in the driver."""
    return df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
