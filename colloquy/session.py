"""Session construction and shared-storage helpers.

On a cluster the session is built by the platform; these helpers only fill
in settings that are still unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the library relies on; applied only when the caller has not set them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "colloquy") -> SparkSession:
    """Local session for tests and the bench (the cluster supplies its own)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.executorEnv.PYTHONWARNINGS", "ignore::FutureWarning")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


_SHIPPED: set[str] = set()  # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that Python
    functions run there wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="colloquy-pkg-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults that the session does not set yet. A ``local`` session
    (tests, the bench, the driver's own checks) without ``spark.checkpoint.dir`` gets a
    folder of its own: there the single machine is the whole cluster."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    master = spark.sparkContext.master
    if not _named_dir(spark) and (master == "local" or master.startswith("local[")):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="colloquy-ckpt-"))
    shared_dir(spark)
    ship_package(spark)
    return spark


def _named_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written tables, as
    ``spark.checkpoint.dir`` names it."""
    named = _named_dir(spark)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)  # only a path that exists can be marked
    fs.deleteOnExit(hadoop)
    return path


def materialize(df, name: str):
    """Write ``df`` once to a fresh folder under the shared folder and read it
    back: an intermediate that feeds several branches is computed once, and
    its lineage is cut (a lost executor recomputes nothing upstream)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
