"""Session helpers: local sessions for tests, and where scratch tables may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings the results depend on; both can be changed on a running session.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}


def local_session(cpus: int = 8, app: str = "logweave", **conf: str) -> SparkSession:
    """A small single-JVM session for tests and benches (a cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for key, value in {**RESULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session somebody else made."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names.

    ``spark.checkpoint.dir`` decides.  Only a local master, where driver and
    executors share one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="logweave-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
