"""Session settings the library relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings, safe to apply to a session somebody else created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sources written in Python run to the end of the data, and past the watermark, like others.
    "spark.sql.streaming.triggerAvailableNowWrapper.enabled": "true",
}

# Settings that only count when the session is created.
STATIC = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(app: str = "eddyline", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave `master` to the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**STATIC, **RUNTIME, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings, `RUNTIME`, to an existing session, which keeps them."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: `spark.checkpoint.dir`, which a cluster must name.

    Only a local session, whose executors are this very process, falls back to a
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="eddyline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
