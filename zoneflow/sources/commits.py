"""Commits of a table made of folders: one small file per commit names everything that readers may see."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from zoneflow.sources.folders import file_system, read_text

FOLDER = "_commits"  # readers of data files skip names that begin so
KEPT = 2  # commits whose folders stay, so that a reader may finish with the one it began with


def commit(spark: SparkSession, root: str, number: int, state: dict, kept: int | None = KEPT) -> None:
    """Make ``state`` what readers of ``root`` see. It appears whole or not at all: written aside, then renamed.

    ``kept`` newest commits stay, all of them if it is None.
    """
    files, folder = file_system(spark, f"{root}/{FOLDER}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(folder)
    aside = path(folder, f".{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if not files.rename(aside, path(folder, f"{number}.json")):
        raise RuntimeError(f"commit {number} of {root} is there already")
    for old in _numbers(spark, root)[:-kept] if kept else []:
        files.delete(path(folder, f"{old}.json"), False)


def newest(spark: SparkSession, root: str) -> dict | None:
    """The state that counts now; None before the first commit."""
    states = last_states(spark, root, 1)
    return states[0] if states else None


def newest_number(spark: SparkSession, root: str) -> int | None:
    numbers = _numbers(spark, root)
    return numbers[-1] if numbers else None


def last_states(spark: SparkSession, root: str, count: int = KEPT) -> list[dict]:
    """The newest states, newest first."""
    return [json.loads(read_text(spark, f"{root}/{FOLDER}/{number}.json")) for number in _numbers(spark, root)[::-1][:count]]


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, folder = file_system(spark, f"{root}/{FOLDER}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())
