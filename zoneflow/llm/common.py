"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import zoneflow

#: Word separators of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas of ``body``."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda word: word != "")


def row_key(*columns: Column) -> Column:
    """Key of a row by content, for rows whose id is null or repeated: rows with one key are equal for its columns."""
    return F.xxhash64(*[c for column in columns for c in (column.isNull(), column)])


def word_count(text: Column) -> Column:
    """Number of words of a non-null text: places where a word starts."""
    return F.regexp_count(text, F.lit(WORD_PATTERN + "+")).cast("long")


def hashed_sample(rows: DataFrame, key: Column, bound: int, where: Column | None = None) -> DataFrame:
    """At most ``bound`` rows, those with the smallest ``key`` (a 64-bit hash) among those that ``where`` holds for.

    Large tables are thinned by the key's low bits first, so that sorting never sees more than a few times ``bound`` rows.
    """
    share = 4 * bound / max(1, rows.count())
    if share < 1:
        rows = rows.filter(F.pmod(key, F.lit(1 << 20)) <= int(share * (1 << 20)))
    if where is not None:
        rows = rows.filter(where)
    return rows.orderBy(key).limit(bound)


def text_slices(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of at most ``size`` bytes in ``column``, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, end - at)
            at = end


def ship_package(spark: SparkSession) -> None:
    """Hands this library's code to the Python workers, once per application, through Spark's own file distribution.

    Workers import what tasks refer to; a driver that found the library by its working folder has told them nothing.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(zoneflow.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="zoneflow-code-")) / "zoneflow.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
