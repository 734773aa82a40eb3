"""Session helpers.

On a cluster the session is built by the platform; these helpers only fill in
settings that are still unset, so a cluster configuration always wins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the library relies on.  Applied only when the key is unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a semi join filters the large side at its scan; a filter holds at most 8 MB
    # whatever this says, the setting only bounds the side it is made from
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "care-analytics") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set library defaults that the running session leaves unset."""
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    return spark
