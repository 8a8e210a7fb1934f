"""Numbered folders of one table: versions, batches, folded logs. A folder counts once its write has committed."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def numbered(spark: SparkSession, root: str, name: str, committed: bool = True) -> dict[int, str]:
    """Paths of the folders ``name=N`` directly below ``root`` by number; none when ``root`` is not there.

    ``committed=False`` also lists those that a crashed write has left behind.
    """
    files, path = file_system(spark, root)
    if not files.exists(path):
        return {}
    found = {}
    for status in files.listStatus(path):
        child = status.getPath()
        head, _, number = child.getName().partition("=")
        if status.isDirectory() and head == name and number.isdigit():
            success = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(child, "_SUCCESS")
            if not committed or files.exists(success):
                found[int(number)] = child.toString()
    return found


def subfolders(spark: SparkSession, root: str, name: str) -> list[str]:
    """Paths of the folders ``name=…`` directly below ``root``."""
    files, path = file_system(spark, root)
    if not files.exists(path):
        return []
    return sorted(s.getPath().toString() for s in files.listStatus(path)
                  if s.isDirectory() and s.getPath().getName().startswith(f"{name}="))


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the files that a write has left in ``folder``, by name: the order of its partitions."""
    files, path = file_system(spark, folder)
    return sorted(s.getPath().toString() for s in files.listStatus(path)
                  if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def set_order(spark: SparkSession, paths: list[str]) -> None:
    """Modification times a second apart, so that a file stream takes the files in the order of ``paths``."""
    for second, name in enumerate(paths):
        files, path = file_system(spark, name)
        files.setTimes(path, (1_700_000_000 + second) * 1000, -1)


def remove(spark: SparkSession, folder: str) -> None:
    files, path = file_system(spark, folder)
    files.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below ``folder``."""
    files, path = file_system(spark, folder)
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content, read by the driver alone."""
    files, at = file_system(spark, path)
    stream = files.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def query_folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    """The folder below ``path`` of the query that has this checkpoint, by the id that it keeps there from its first start on."""
    first = read_text(spark, f"{checkpoint.rstrip('/')}/metadata").splitlines()[0]
    return f"{path}/query={json.loads(first)['id']}"


def file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
