"""The update log of a price stream, folded as it grows.

Every batch is a folder, and one commit per batch names the folders that readers see, so a batch shows whole or not at all. Every
so many batches the open part of the log (the batches since the last fold, and what that left open) is folded. Rows of windows
that can no longer change go into closed folders, which no later fold reads again; so what a fold rewrites follows the windows
that are open, not the length of the history. Closed folders are put together level by level, as a merge tree, to keep their
number small: a row moves up at most ``levels`` times.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from zoneflow.operators.pricing import compact_updates
from zoneflow.params import PricingParams
from zoneflow.sources.commits import commit, last_states, newest
from zoneflow.sources.folders import children, exists, query_folder, remove, subfolders

EMPTY = {"batch": -1, "rows": 0, "rewritten": 0, "waiting": 0, "end": None, "open": [], "closed": []}
KEYS = ("h3_zone", "window_start")  # of ``compact_updates``
FOLD_ROWS = 500_000  # rows that a task of a fold takes: its hash maps stay small, however long the log and whatever the shuffle width


@dataclass(frozen=True)
class Folding:
    """``every``: batches between two folds. ``open_seconds``: a window that ends so long before the newest window's end does not
    change any more; the window's length plus the watermark's delay is safe for any stream of ``pricing_stream``, as a window
    ends at most one length after the event that makes it. ``fanout`` closed folders of a level become one of the next."""

    open_seconds: int
    every: int = 100
    fanout: int = 8
    levels: int = 2
    fold: Callable[[DataFrame], DataFrame] = compact_updates

    @classmethod
    def of(cls, params: PricingParams, **more: object) -> Folding:
        return cls(open_seconds=2 * params.window_seconds, **more)


def log_sink(rows: DataFrame, path: str, checkpoint: str, folding: Folding, mode: str = "update") -> DataStreamWriter:
    """Writer of an update log with a ``window_end``, one folder per query below ``path``.

    A batch that is run again after it was committed changes nothing; one that failed before replaces what it had written.
    """
    own: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not own:
            own.append(query_folder(batch.sparkSession, path, checkpoint))
        append(batch, own[0], batch_id, folding)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)


def append(batch: DataFrame, own: str, batch_id: int, folding: Folding) -> None:
    """Add one batch to the log of one query, fold it where that is due, and commit both at once."""
    spark = batch.sparkSession
    state = newest(spark, own) or EMPTY
    if batch_id <= state["batch"]:
        return
    seen = Observation()
    batch.observe(seen, F.max(F.unix_micros(F.col("window_end").cast("timestamp"))).alias("end"), F.count(F.lit(1)).alias("rows")).hint(
        "rebalance").write.mode("overwrite").parquet(f"{own}/batch_id={batch_id}")
    found = seen.get
    after = state | {
        "batch": batch_id, "rows": state["rows"] + found["rows"],
        "waiting": state.get("waiting", state["rows"]) + found["rows"], "open": [*state["open"], f"batch_id={batch_id}"],
        "end": max((end for end in (state["end"], found["end"]) if end is not None), default=None)}
    due = (batch_id + 1) % folding.every == 0
    if due:
        # Late rows are turned away by a watermark that is one batch old, so this batch does not count for what is closed.
        after = _folded(spark, own, after, state["end"], folding)
    commit(spark, own, batch_id, after)
    if due:
        _sweep(spark, own)


def _folded(spark: SparkSession, own: str, state: dict, end: int | None, folding: Folding) -> dict:
    name = f"fold={state['batch']}"
    closed = F.lit(False)
    if end is not None:
        last = F.timestamp_micros(F.lit(end - folding.open_seconds * 1_000_000))
        closed = F.coalesce(F.col("window_end").cast("timestamp") <= last, F.lit(False))
    seen = Observation()
    rows = _read(spark, own, state["open"])
    # dealt out by key before the fold: most keys have one version, so a sum before the shuffle would only fill hash maps
    dealt = rows.repartition(1 + state["waiting"] // FOLD_ROWS, *[key for key in KEYS if key in rows.columns])
    folding.fold(dealt).withColumn("_closed", closed).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_closed")).alias("waiting"),
    ).write.mode("overwrite").partitionBy("_closed").parquet(f"{own}/{name}")
    rewritten, waiting = seen.get["rows"], seen.get["waiting"]
    parts = {flag: f"{name}/_closed={flag}" for flag in ("true", "false") if exists(spark, f"{own}/{name}/_closed={flag}")}
    runs = [*state["closed"], *([[0, parts["true"]]] if "true" in parts else [])]
    for level in range(folding.levels):
        same = [run for run in runs if run[0] == level]
        if len(same) >= folding.fanout:
            merged, moved = f"merged={state['batch']}-{level + 1}", Observation()
            _read(spark, own, [folder for _, folder in same]).observe(moved, F.count(F.lit(1)).alias("rows")).hint(
                "rebalance").write.mode("overwrite").parquet(f"{own}/{merged}")
            runs = [run for run in runs if run[0] != level] + [[level + 1, merged]]
            rewritten += moved.get["rows"]
    return state | {
        "open": [parts["false"]] if "false" in parts else [], "waiting": waiting, "closed": runs, "rewritten": state["rewritten"] + rewritten}


def _sweep(spark: SparkSession, own: str) -> None:
    """Remove what no kept commit names: folded batches, and what crashed writes have left."""
    states = last_states(spark, own)
    named = {folder for state in states for folder in state["open"] + [run[1] for run in state["closed"]]}
    for name in children(spark, own):
        if name.startswith("fold="):
            for part in children(spark, f"{own}/{name}"):
                if f"{name}/{part}" not in named:
                    remove(spark, f"{own}/{name}/{part}")
            if not children(spark, f"{own}/{name}"):
                remove(spark, f"{own}/{name}")
        elif name.startswith(("batch_id=", "merged=")) and name not in named:
            remove(spark, f"{own}/{name}")


def _read(spark: SparkSession, own: str, folders: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{own}/{folder}" for folder in folders])


def read_committed(spark: SparkSession, own: str, fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
    """All rows of one query's log; with ``fold`` the open part is folded, and closed rows are what they are."""
    state = newest(spark, own)
    if not state:
        return None
    parts = []
    if state["open"]:
        rows = _read(spark, own, state["open"])
        parts.append(fold(rows) if fold else rows)
    if state["closed"]:
        parts.append(_read(spark, own, [folder for _, folder in state["closed"]]))
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_folded(spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame] = compact_updates) -> DataFrame:
    """The newest version of every row of a log that one or more queries have written."""
    logs = [read_committed(spark, own, fold) for own in subfolders(spark, path, "query")]
    logs = [log for log in logs if log is not None]
    if not logs:
        raise RuntimeError(f"no committed batches in {path}")
    return logs[0] if len(logs) == 1 else fold(reduce(DataFrame.unionByName, logs))


def log_counts(spark: SparkSession, path: str) -> DataFrame:
    """Batches committed, rows written and rows that folds have written again, by query: kept with the commits, so they outlive
    the driver that counted them."""
    states = [(own.rsplit("=", 1)[1], newest(spark, own)) for own in subfolders(spark, path, "query")]
    return spark.createDataFrame(
        [(query, s["batch"] + 1, s["rows"], s["rewritten"]) for query, s in states if s],
        "query string, batches long, rows_written long, rows_rewritten long")
