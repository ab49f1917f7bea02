"""Session builder and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quillspark", cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with adaptive execution, UTC and Arrow. On a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the workers, once for each application, so that its Arrow functions load
    wherever the driver was started. Spark's own file server hands them to every executor, also to one that comes
    later; where the package's folder is shared, workers find it there too."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    above = os.path.dirname(package)
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if above not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([above, *paths])
    # beside the checkpoints, a folder that all share; without a path there (or elsewhere than on a file system that
    # Python can write) workers find the package by its own folder or as it was installed
    shared = checkpoint_dir(spark).removeprefix("file://").removeprefix("file:")
    if "://" not in shared and os.path.isdir(os.path.dirname(shared.rstrip("/")) or "/"):
        folder = os.path.join(shared, f"sources-{sc.applicationId}")
        os.makedirs(folder, exist_ok=True)
        name = os.path.join(folder, "quillspark_sources.zip")
        with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
            for root, _, files in os.walk(package):
                for f in files:
                    if f.endswith(".py"):
                        out.write(os.path.join(root, f), os.path.relpath(os.path.join(root, f), above))
        sc.addPyFile(name)
    _shipped.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in spark.checkpoint.dir; only where that is unset (tests,
    local runs) a temporary one is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quillspark-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from the files: a lost executor costs no recomputation
    of what came before, and a loop's plan doesn't grow."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
