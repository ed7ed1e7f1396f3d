"""Session helpers: UTC clock, AQE, checkpoint folder from the cluster config."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "curata",
                  shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Local/test session builder.  On a cluster use the cluster's own session
    and call :func:`prepare` on it instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # CPU-heavy parse stages follow small shuffles: keep them spread over the cores
          .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:   # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``curata`` importable in every Python worker (UDFs reference its
    functions): zip the package once per application and ``addPyFile`` it.

    The zip holds code only; it is staged on the driver and served to executors
    by Spark.  Deployments that already ship the package (``--py-files``) can
    turn this off with ``spark.curata.shipPackage=false``.
    """
    try:
        if str(spark.conf.get("spark.curata.shipPackage", "true")).lower() == "false":
            return
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext access: rely on the deployment
        return
    if app in _SHIPPED:
        return
    import zipfile

    import curata
    pkg = os.path.dirname(os.path.abspath(curata.__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="curata-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC (all date rules are UTC), keep AQE on and make
    the package importable by the Python workers."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` session (tests, one machine) that names none gets a temporary
    folder; on a cluster a machine-local folder would lose data, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="curata-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about 4 MB where the session names no size of its own: Spark's are bounded by
    10,000 rows and 64 MB, and both sides of a Python stage hold one or two of them."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")


def cut_lineage(df, enabled: bool = True):
    """Reliable checkpoint into ``spark.checkpoint.dir`` (never a local checkpoint).

    Used between the expensive scan/parse stage of a job and its joins so that a
    lost executor costs a re-read of the checkpoint, not a re-parse of payloads.
    """
    if not enabled:
        return df
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
