"""Session builder for tests, benchmarks and the driver entry.

Cluster jobs get their session from the platform; the library itself never
sets configuration on a session it did not build.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the engine relies on: UTC for timestamp text and epoch math,
# adaptive execution for broadcast choice, skew splitting and coalescing.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "chunkwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamp text and epoch math assume a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def cluster_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run: initial shuffle partitions sized from the
    biggest expected shuffle (at least two per core), adaptive coalescing down
    to ``partition_bytes`` and skew splitting. Pass them to the session builder."""
    parts = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        **{k: v for k, v in ENGINE_CONF.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }
