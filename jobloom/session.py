"""Settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024**2


def apply_settings(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Set what the operators rely on; with ``shuffled_bytes``, also enough shuffle partitions for a shuffle that large.

    The number is only ever raised: partitions that turn out small are joined by adaptive execution, while too few make
    tasks that spill. Deduplicating 20 TB of postings, for example, asks for some 160,000 partitions rather than 200.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffled_bytes is not None:
        present = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = -(-shuffled_bytes // BYTES_PER_SHUFFLE_PARTITION)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(present, wanted)))
    return spark
