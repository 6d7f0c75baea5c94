"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; none of them needs a session restart.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split even when that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.exchange.reuse": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "flowloom") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/flowloom-{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold meanwhile."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(df: DataFrame, path: str, conf: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``df`` written to ``path`` and read back; the shuffles that made them are removed from the disk.

    ``conf`` holds while they are made.
    """
    spark = df.sparkSession
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **(conf or {})}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder below ``shared_dir`` that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, as ``--py-files`` would; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # a package inside a zip was shipped already
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        archive = shutil.make_archive(
            f"{folder}/flowloom", "zip", os.path.dirname(package), os.path.basename(package)
        )
        spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
