"""Session helpers: building a session for tests/bench, and the shared
folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on; a cluster's own settings win when present.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ticketloom", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (no UI, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_settings(spark: SparkSession) -> None:
    """The one SQL setting that results depend on, for sessions that were not
    made by ``build_session``: repeated keys in nested JSON keep the last
    value, as in Python."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    This is whatever ``spark.checkpoint.dir`` names (on a cluster: a shared
    file system).  When nothing is configured, a session with a ``local``
    master gets a folder under the system temp directory; any other session
    gets an error, as its executors would not share one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ticketloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (what
    ``spark-submit --py-files`` does): zip it once per application and hand
    it to ``addPyFile``, which distributes it to every executor.  Needed
    wherever Python functions from the package run in tasks (mapInPandas)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    # read only on the driver by addPyFile, which ships the bytes itself
    out = os.path.join(tempfile.mkdtemp(prefix="ticketloom-pyfiles-"), "ticketloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
