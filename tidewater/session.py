"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time options every operator assumes.

    Windows align to the epoch, so the session works in UTC. ``transformWithState`` needs the RocksDB
    state store, which also keeps large state off the JVM heap.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that it need not be installed there."""
    sc = spark.sparkContext
    name = f"tidewater-{sc.applicationId}.zip"
    if any(name in f for f in sc._python_includes):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidewater-code-")) / name  # the driver serves it from there
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(target))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local master (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
