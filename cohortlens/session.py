"""Session settings the operators were tuned with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Partition sizes, join strategies and skewed partitions are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods above this size are not compiled by the JVM.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def tune(spark: SparkSession) -> None:
    """Hold the limit of generated methods in a session that was not configured.

    The JVM interprets methods above it, which made wide projections of sections several times slower.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(SETTINGS[name]):
        spark.conf.set(name, SETTINGS[name])


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
