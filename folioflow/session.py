"""Session construction and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job relies on, unless the user has set them.  AQE re-plans
# from runtime sizes: it coalesces the tiny post-aggregation partitions,
# turns a sort-merge join into a broadcast only once the small side's real
# size is known, and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "folioflow", **conf: str) -> SparkSession:
    """Create (or reuse) a session with :data:`SESSION_DEFAULTS` where nothing is set, plus ``conf``.

    What ``spark-submit --conf`` or the cluster's defaults set stays.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()  # what the launcher has set
    defaults = {k: v for k, v in SESSION_DEFAULTS.items() if not given.contains(k)}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local master (one machine, as in tests) gets a folder made here
    when the session names none, removed when the process ends; on a cluster
    the setting is required, as nodes do not share their own folders.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this side (e.g. Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        configured = tempfile.mkdtemp(prefix="folioflow-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Only needed where the workers cannot import it themselves (not installed
    there, and not on the launcher's ``PYTHONPATH``).
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if home in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="folioflow-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "folioflow.zip")
    with zipfile.ZipFile(target, "w") as z:
        for top, _, names in os.walk(os.path.join(home, "folioflow")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, home))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path under :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str:
    """``file:/x`` → ``/x`` (for tests that inspect a local tree)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri

