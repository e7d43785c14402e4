"""Storage that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A local master may do without: its driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(shared_dir, "own", None):
        shared_dir.own = "file://" + tempfile.mkdtemp(prefix="scholium-")
    return shared_dir.own


def clear() -> None:
    """Delete all that stored() wrote so far; frames that read it can't be used any more. Runs when the driver ends."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is then the cluster's to clear
            pass


atexit.register(clear)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which clear() deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and a lost executor costs a reread at most."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
