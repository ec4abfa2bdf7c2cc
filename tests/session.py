"""The local Spark session of tests and checks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("dispatchlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
