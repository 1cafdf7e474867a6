"""Session helpers shared by every module: code shipping, scratch tables, sessions for tests."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, str] = {}


def local_session(cores: str = "8", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that UDFs import it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    if root.suffix == ".zip" or not root.is_dir():  # already running from a shipped archive
        return
    folder = tempfile.mkdtemp(prefix="loam-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "loam_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, Path("loam") / path.relative_to(root))
    context.addPyFile(target)
    _SHIPPED[context.applicationId] = target


def scratch_base(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where it is unset, a folder of this process in local mode (tests); on a
    cluster that is an error, as other machines don't see the driver's folders."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="loam-scratch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir("file://" + folder)
        base = context.getCheckpointDir()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it goes when the application ends."""
    path = f"{scratch_base(spark)}/loam-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """Write df below the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
