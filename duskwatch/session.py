"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Timestamps are UTC end to end.
    "spark.sql.session.timeZone": "UTC",
    # A JSON document with a repeated key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Hot keys: AQE splits skewed join partitions and merges small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Beyond this size the JVM does not compile a generated method; the wide
    # projections here run faster as several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "duskwatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and work tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    a local folder is made only where the setting is absent (tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        path = tempfile.mkdtemp(prefix="duskwatch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path
