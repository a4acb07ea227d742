"""Session settings that the jobs profit from; none changes a result."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Re-plan at run time: merge small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of more than 8000 bytes.  A wide cleaning
    # projection can exceed that; Spark then does better with smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark
