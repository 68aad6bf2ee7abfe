"""Session helpers: reading tables, durable cuts of lineage, checked broadcasts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its statistics say at most so many bytes, or after counting that it has at most so many rows.
BROADCAST_BYTES, BROADCAST_ROWS = 4 << 20, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local session, whose executors are threads of this machine, gets a
    temporary folder; a cluster is told to set it. Folders in it are deleted with the session.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="factloom-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        forget(spark, context.getCheckpointDir())
    return context.getCheckpointDir()


def forget(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate data when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` is small: by the plan's statistics, or else because it has at most ``limit`` rows.

    Otherwise the join is left to the optimizer. Only where the statistics do not tell is
    the input evaluated once more to count it.
    """
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= BROADCAST_BYTES:
        return F.broadcast(df)
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python stages can import it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="factloom-ship-")) / "factloom-package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
