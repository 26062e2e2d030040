"""Session construction and the shared working folder.

Jobs that cut lineage or keep streaming state write under the folder the cluster names in
``spark.checkpoint.dir``. We only pick our own folder when that setting is absent, which
is the local/test case.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints (frozen paging ranges, marker stages) are removed once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "domus", **conf: str) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC session time and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # Settings that matter for correctness are re-applied on a reused session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


# Where a local session without ``spark.checkpoint.dir`` (tests, a local run) keeps its
# folder. ``spark.checkpoint.dir`` itself is a core setting Spark will not change at runtime.
FALLBACK_ROOT_KEY = "spark.domus.fallbackCheckpointRoot"


def is_local(spark: SparkSession) -> bool:
    """Do the driver and all tasks share one machine's folders?"""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only a local session may go without: it gets a
    private temp folder. Anywhere else a machine's own folder would lose data, so it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FALLBACK_ROOT_KEY, None)
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="domus-ckpt-")
        spark.conf.set(FALLBACK_ROOT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named path under the shared checkpoint root; Spark's writers create it."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
