"""Session helpers: a tuned builder and the place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "trawl", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.

    Spark itself distributes the archive from the driver; nothing reads it from a shared path.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="trawl-code-"), "trawl_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints, reading ``spark.checkpoint.dir`` first.

    Only a local master may fall back to a temporary folder: on a cluster it would not be
    visible to the other machines.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="trawl-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def cut_lineage(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor.

    ``dealt`` keeps how rows are partitioned and sorted, which adaptive plans forget: joins by that
    key leave them where they are.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if not dealt:
        return df.checkpoint(eager=True)
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    adaptive = conf.get(name)
    try:
        conf.set(name, "false")
        # A new plan: that of ``df`` may have been made before.
        return df.select("*").checkpoint(eager=True)
    finally:
        conf.set(name, adaptive)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside drops its shuffle files when it ends, and not when the driver happens to
    collect its garbage; so a table's files never lie beside those of all earlier shuffles."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
