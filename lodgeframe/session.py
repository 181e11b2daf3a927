"""Session settings shared by every job.

The settings that change results are applied to whatever session is passed
in (``configure``), so operators behave the same in tests, in the bench and
on a cluster:

* session time zone UTC (date text <-> timestamp is stable),
* ``mapKeyDedupPolicy=LAST_WIN`` (a tag repeated in one map element keeps the
  last value, like a Python dict comprehension),
* AQE with partition coalescing and skew-join splitting on.

Where a job runs (master, memory, shuffle partitions) is the caller's choice:
``get_session`` sets these only if they are passed, so ``spark-submit`` and
the cluster's defaults stay in force.

Lineage cutting uses ``spark.checkpoint.dir`` from the session. A cluster must
name a shared folder there; without one, a job that needs it fails with a
clear error. Only a local session may do without: its warehouse folder serves.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RESULT_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting settings to an existing session."""
    for key, value in RESULT_CONFS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, also set on its context."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lodgeframe", driver_memory: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session; only what is passed overrides the submitted settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = {"spark.ui.enabled": "false",
              "spark.cleaner.referenceTracking.cleanCheckpoints": "true", **RESULT_CONFS}
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        chosen["spark.driver.memory"] = driver_memory
    for key, value in (chosen | (conf or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def local_session(app_name: str = "lodgeframe", cpus: str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g") -> SparkSession:
    """One-machine session for tests, tools and the bench."""
    return get_session(f"local[{cpus}]", shuffle_partitions, app_name, driver_memory,
                       {"spark.ui.showConsoleProgress": "false"})
