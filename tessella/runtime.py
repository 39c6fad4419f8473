"""Making this package importable in Python workers, and cutting lineage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors, once per application.

    Functions that run in Python workers are imported there by name.  A package that was
    already sent as an archive is left alone.
    """
    context = spark.sparkContext
    root = Path(__file__).parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tessella-"), "tessella.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; set here only if nothing set it (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    jvm_folder = spark.sparkContext.getCheckpointDir()
    if jvm_folder:
        return jvm_folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessella-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from there."""
    folder, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out over all cores by ``keys``, for work that costs more than its rows' bytes tell.

    By bytes alone small tables come to one task.  A join by the keys needs no further exchange of ``df``.
    """
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
