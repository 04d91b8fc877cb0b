"""Folders for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate files, in the cluster's shared checkpoint folder.

    Only a local session without that setting gets a machine-local one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="rollcall-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage ends here."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
