"""Spark session policy.

The library never creates a session behind the caller's back: every public
function takes ``spark`` or DataFrames. ``build_session`` is a convenience for
tests, the bench and command-line runs.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress
from pathlib import Path
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
T = TypeVar("T")


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "wxmesh", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("WXMESH_DRIVER_MEMORY", "16g"),
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The session may already exist (getOrCreate): enforce the settings the
    # library relies on for correct timestamps.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    It is the location named in ``spark.checkpoint.dir`` (read from the
    session). Only on a local master may it be unset: then a fresh scratch
    folder is registered. On a cluster a machine-local folder would leave each
    executor's files where the others cannot read them, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        if not is_local(sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="wxmesh-ckpt-",
                                   dir=os.environ.get("WXMESH_SCRATCH", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """One JVM (``local``, ``local[n]``); ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Functions that run in tasks are known to them by module and name, so they
    must be able to import it, wherever the driver was started.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="wxmesh-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(path))  # the driver serves it to the executors
    _shipped.add(sc.applicationId)


class Scratch:
    """Owner of the tables a job writes for itself; ``release`` removes them.

    ``materialise`` and ``scratch_path`` register with the innermost owner that
    is open (see ``scratch``). Outside of any, the session owns them until
    ``release_scratch`` or the end of the Python process.
    """

    def __init__(self):
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> None:
        paths, self.paths = self.paths, []
        for path in paths:
            delete_path(spark, path)


_owners: list[Scratch] = [Scratch()]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the file system that its path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession):
    """What is materialised inside is removed at the end, also after an error.

    Nothing that still reads such a table may leave the block unwritten.
    """
    own = Scratch()
    _owners.append(own)
    try:
        yield own
    finally:
        _owners.remove(own)
        own.release(spark)


def release_scratch(spark: SparkSession) -> None:
    """Remove the tables of finished queries of this session."""
    _owners[0].release(spark)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _owners[0].paths else None
    if spark is not None:
        with suppress(Exception):  # the JVM may be gone already
            _owners[0].release(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _owners[-1].paths.append(path)
    return path


def together(*jobs: Callable[[], T]) -> list[T]:
    """Run independent jobs (each writes, counts or measures a frame) at the same time and return their results.

    Spark takes jobs from several threads; stages of a few tasks, which leave
    cores idle, then overlap. Frames are built by the caller's thread.
    """
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [running.result() for running in [pool.submit(job) for job in jobs]]


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    read it back: lineage is cut (a lost executor does not recompute the
    upstream joins and shuffles) and later readers get column pruning and
    predicate pushdown. The schema is passed on the read, so types (for
    example zero-padded ids) survive as declared.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
