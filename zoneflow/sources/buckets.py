"""A keyed table in hash buckets: an upsert reads and writes the buckets that its keys lie in, and no others.

Every bucket is a folder of its own, and each upsert puts the new versions of the buckets it touches into a run of their own. One
commit per upsert says which run each bucket is to be read from, so readers see all of an upsert or nothing of it. Files are
those of a table bucketed by the key, so the stored side of a merge is already dealt out as the join needs it: only the updates
are shuffled.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zoneflow.operators.upsert import merge_rows
from zoneflow.session import new_folder
from zoneflow.sources.commits import commit, last_states, newest
from zoneflow.sources.folders import children, remove

BUCKET = "_bucket"
SWEPT = 8  # upserts between two searches for files that no kept commit names
CHANGES = ("matched", "modified", "upserted")


@dataclass(frozen=True)
class BucketTable:
    """``buckets`` is fixed by the first upsert: one per some hundred megabytes of table, or more where upserts touch few keys.

    Rows whose key is null are left out. One writer at a time."""

    root: str
    key: str
    buckets: int = 64

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All rows; None before the first upsert."""
        state = newest(spark, self.root)
        if not state:
            return None
        schema = StructType.fromJson(json.loads(state["schema"]))
        folders = [f"{self.root}/{run}/{BUCKET}={bucket}" for bucket, run in state["runs"].items()]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def upsert(self, updates: DataFrame, keep: tuple[str, ...] = (), number: int | None = None,
               newer: Callable[[Column, Column], Column] | None = None) -> dict[str, int]:
        """Replace rows whose key is known and insert the rest, as ``merge_rows``; returns what happened to the touched buckets.

        ``number`` is that of a stream's batch: an upsert whose number is not above the last one's changes nothing. Keys of
        ``updates`` are unique.
        """
        spark = updates.sparkSession
        state = newest(spark, self.root) or {"number": -1, "runs": {}, "total": 0, "buckets": self.buckets, "schema": updates.schema.json()}
        number = state["number"] + 1 if number is None else number
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {state['buckets']} buckets")
        if number <= state["number"]:
            return dict.fromkeys(CHANGES, 0) | {"total": state["total"], "rewritten": 0, "touched": 0}
        held = new_folder(spark, "updates")
        updates.where(F.col(self.key).isNotNull()).write.parquet(held)  # read twice
        updates = spark.read.schema(updates.schema).parquet(held)
        touched = [str(row[0]) for row in updates.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        run = f"run={number}-{uuid.uuid4().hex[:8]}"
        changes = dict.fromkeys(CHANGES, 0) | {"rewritten": 0}
        if touched:
            names: list[str] = []  # entries in the session's catalog, for as long as the merge runs
            changes = self._write(self.merged(spark, state, updates, touched, names, keep, newer), run, names)
        total = state["total"] + changes["upserted"]
        commit(spark, self.root, number, state | {
            "number": number, "total": total, "runs": state["runs"] | dict.fromkeys(touched, run)})
        remove(spark, held)
        if number % SWEPT == 0:
            self._sweep(spark)
        return changes | {"total": total, "touched": len(touched)}

    def merged(self, spark: SparkSession, state: dict, updates: DataFrame, touched: list[str], names: list[str],
               keep: tuple[str, ...] = (), newer: Callable[[Column, Column], Column] | None = None) -> DataFrame:
        """The rows of the touched buckets after the upsert. The stored side is read bucket by bucket and not shuffled; for that it
        becomes a table of the session's catalog, whose name is added to ``names``."""
        stored = [bucket for bucket in touched if bucket in state["runs"]]
        target = self._table(spark, state, stored, names) if stored else spark.createDataFrame([], updates.schema)
        return merge_rows(target, updates.select(*target.columns), self.key, keep, newer)

    def _bucket(self) -> Column:
        """The bucket that Spark's own bucketed writes put a row into."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).alias(BUCKET)

    def _table(self, spark: SparkSession, state: dict, buckets: list[str], names: list[str]) -> DataFrame:
        """Some buckets as a bucketed table of the session's catalog, which is told where each of them lies."""
        name = f"buckets_{uuid.uuid4().hex}"
        columns = spark.createDataFrame([], StructType.fromJson(json.loads(state["schema"])))._jdf.schema().toDDL()
        spark.sql(f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                  f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.root}/_table'")
        places = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{self.root}/{state['runs'][b]}/{BUCKET}={b}'" for b in buckets)
        spark.sql(f"ALTER TABLE {name} ADD {places}")
        names.append(name)
        return spark.table(name).drop(BUCKET)

    def _write(self, merged: DataFrame, run: str, names: list[str]) -> dict[str, int]:
        spark, seen, name = merged.sparkSession, Observation(), f"buckets_{uuid.uuid4().hex}"
        change = F.col("change")
        counted = merged.observe(
            seen, F.count_if(change.isin("same", "modified")).alias("matched"), F.count_if(change == "modified").alias("modified"),
            F.count_if(change == "inserted").alias("upserted"), F.count(F.lit(1)).alias("rewritten"))
        counted.drop("change").withColumn(BUCKET, self._bucket()).write.partitionBy(BUCKET).bucketBy(self.buckets, self.key).option(
            "path", f"{self.root}/{run}").format("parquet").saveAsTable(name)
        for table in (name, *names):  # the files stay
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        return dict(seen.get)

    def _sweep(self, spark: SparkSession) -> None:
        """Remove bucket versions that no kept commit names."""
        states = last_states(spark, self.root)
        named = {f"{run}/{BUCKET}={bucket}" for state in states for bucket, run in state["runs"].items()}
        for run in children(spark, self.root):
            if run.startswith("run="):
                parts = children(spark, f"{self.root}/{run}")
                for part in parts:
                    if f"{run}/{part}" not in named:
                        remove(spark, f"{self.root}/{run}/{part}")
                if not any(f"{run}/{part}" in named for part in parts):
                    remove(spark, f"{self.root}/{run}")
