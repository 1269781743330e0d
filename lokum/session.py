"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (dates and the recency cutoff
# are computed in UTC), AQE for runtime re-planning (partition coalescing, skew
# join splitting, sort-merge -> broadcast demotion when a side turns out small).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # queries that make pages of an order's rows set it (``sorted_groups``)
    "spark.sql.execution.replaceHashWithSortAgg": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lokum", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (local[N], UI off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LOKUM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep theirs
            pass
    ship_package(spark)
    return spark


def sorted_groups(spark: SparkSession) -> None:
    """For the query that is being built: groups whose rows lie sorted by a join already
    are put together one after the other. A hash table of lists would be given up after
    128 groups, and the rows sorted anew."""
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, so that
    the batch hooks run whatever folder or machine a worker starts in."""
    sc = spark.sparkContext
    if getattr(sc, "_lokum_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="lokum-package-"))
    archive = os.path.join(folder, "lokum.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for where, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(where, n)
                    z.write(full, os.path.join("lokum", os.path.relpath(full, root)))
    sc.addPyFile(archive)
    sc._lokum_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this must be a shared folder set by the operator; it is read
    from the session. Only when it is unset on a local master (tests, local
    bench) a fresh scratch folder is created for this process.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="lokum-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A job-owned folder under the shared checkpoint folder (snapshots,
    streaming checkpoints, report targets)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
