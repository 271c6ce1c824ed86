"""Session helpers.

The library never builds its own cluster session in production: callers pass a
``SparkSession``.  ``configure`` only sets the SQL options the library relies on
(UTC session time zone for ``timestamptz`` semantics, AQE), and ``local_session``
is for tests and the benchmark.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  All are runtime-settable SQL confs.
REQUIRED_CONF = {
    # every timestamp is an instant in UTC (PostgreSQL timestamptz semantics)
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # of a key that a JSON object repeats the last value counts, as in a dict
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without the setting gets a fresh temporary folder; on a
    cluster a folder of the driver's machine would be lost to the executors, so the
    setting must be there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        current = tempfile.mkdtemp(prefix="marketflow-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "marketflow", driver_memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
