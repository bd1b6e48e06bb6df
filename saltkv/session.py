"""Session helpers: a configured SparkSession and the shared work folder.

Everything this library writes outside a table's own directory (the input
batches and stores that the registered queries and the bench build from the
driver's tables) goes below the folder the cluster names in
``spark.checkpoint.dir``: a shared file system that survives the loss of any
executor.  Loads are staged inside their table (``_staging``).  A machine-local temporary folder is
used only when that setting is absent *and* Spark runs in local mode, as in
tests; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app_name: str = "saltkv", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of this session (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="saltkv-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
