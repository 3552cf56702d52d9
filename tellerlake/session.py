"""Session settings for a cluster or a local run."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the reducers, splits hot join partitions and swaps a sort-merge
# join for a broadcast once it has measured the side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """A session on this machine; ``shared`` names the folder for intermediate tables."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tellerlake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared)
    return (
        builder.config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
