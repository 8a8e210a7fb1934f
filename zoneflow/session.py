"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Shuffle width is left to the cluster: batch plans are coalesced by
# adaptive execution, and a stream's width is frozen into its checkpoint on the first run.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a commit uploads what the batch changed, not the whole store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
STATE_SETTINGS = {name: value for name, value in SETTINGS.items() if ".stateStore." in name}


def build_session(name: str) -> SparkSession:
    """Session for a spark-submit entry point; the master comes from the submit command."""
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="zoneflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder; it goes when the application ends."""
    own = f"{shared_folder(spark)}/zoneflow/{spark.sparkContext.applicationId}"
    if own not in _OWN_FOLDERS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWN_FOLDERS.add(own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


_OWN_FOLDERS: set[str] = set()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Rows are fixed from here on, whatever happens to the executors that made them, and Catalyst
    knows the table's true size: later joins broadcast it only when it is below the threshold.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
