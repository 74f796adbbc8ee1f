"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side already partitioned by some of the join keys stays where it is: the
    # export then moves each artifact once.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stream state on disk: it may outgrow an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Result dumps hold names such as "task-002-boolq:mc::olmes-metrics.json"; the
# checksumming local file system rejects ":" while the raw one accepts it.
LOCAL_FILES = {"spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem"}


def build_session(
    app_name: str = "evalflow",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above; cluster sizing stays with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    options = dict(SETTINGS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            options.update(LOCAL_FILES)
            # its checkpoints need the checksumming local file system
            options.pop("spark.sql.streaming.stateStore.providerClass")
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    options.update(settings or {})
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_folders: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, as named by ``spark.checkpoint.dir``.

    Where that is unset a local session gets a fresh folder of its own, removed when the
    process ends; a cluster session is refused, as no other folder is known to be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        _own_folders[app] = tempfile.mkdtemp(prefix="evalflow-")
        atexit.register(shutil.rmtree, _own_folders[app], ignore_errors=True)
    return _own_folders[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back, for plans that read it twice.

    Columns that a reader does not need are not read, and a lost executor costs no
    recomputation of what lies before.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove what this application put below the shared folder, once its results are written."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
