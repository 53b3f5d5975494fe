"""Spark session and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FILE_FACTOR = "spark.sql.sources.fileCompressionFactor"
#: Bytes in memory for each byte of a compressed file, at most about. Spark takes one for the other where it decides what to broadcast.
IN_MEMORY = 20.0
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "parcelflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the few settings the jobs rely on; everything else stays at Spark's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Stream state on local disk with changes in the checkpoint, instead of all in the heap.
        STATE_STORE: ROCKSDB,
        # Call sites in error messages cost a stack walk per column while a plan is built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="parcelflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


#: Paths handed out inside :func:`temporary`, one list for each that is open.
_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """New, unused path in the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _open_scopes:
        made.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside, at its end; what is needed later must be written elsewhere by then."""
    _open_scopes.append(made := [])
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings of a write: shuffle files go at once, and tables are broadcast by what they take in memory, not as files."""
    own = {SHUFFLE_CLEANUP: "true", FILE_FACTOR: str(max(IN_MEMORY, float(spark.conf.get(FILE_FACTOR, "1.0"))))}
    before = {name: spark.conf.get(name, None) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(df: DataFrame, path: str) -> None:
    """Write ``df``; its shuffle files go at once, not when the driver happens to collect garbage.

    Nothing reads them again: whoever needs the rows reads the table.
    """
    with writing(df.sparkSession):
        df.write.parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage at a place that outlives any executor, and unlike a row checkpoint
    lets later passes read single columns.
    """
    path = scratch_path(df.sparkSession, label)
    written(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that :func:`stored` made, once nothing reads it any more."""
    spark = df.sparkSession
    for name in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partitions and the row order inside them are kept as computed."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
