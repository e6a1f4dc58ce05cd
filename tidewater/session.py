"""Session helpers: one place for the settings every job in this package assumes."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on. UTC matters for every epoch/day/HH:mm value;
# AQE re-plans shuffles at runtime (coalescing, skew-join splitting).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Epoch, day and HH:mm values are defined in UTC; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it) or the context's
    checkpoint directory. Where neither is set, a local master gets a temporary one
    of its own (tests); a cluster is an error, as its executors share no local folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def conf_override(spark: SparkSession, conf: dict):
    """Temporarily set session confs (e.g. around a streaming query's start, which
    snapshots the session; the state partition count then lives in the checkpoint).
    """
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (like ``--py-files``).

    Needed by operators that run Python in tasks (pandas state functions,
    ``mapInPandas``). Zipped once per process and added once per application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="tidewater-pyfiles-")
    archive = shutil.make_archive(os.path.join(staging, "tidewater"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
