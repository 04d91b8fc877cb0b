"""The local session the tests and the bench share."""

import os

from pyspark.sql import SparkSession

from rollcall.session import RECOMMENDED


def local_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rollcall")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config(map=RECOMMENDED)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
