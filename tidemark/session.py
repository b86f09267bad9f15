"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Spark re-plans at run time from measured sizes: it merges small shuffle
# partitions, splits hot ones and broadcasts a side only once its size is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(partitions), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one; it gets a fresh folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system that ``path`` names."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none if it does not exist."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
