"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "opinara", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume.

    On a cluster ``master`` and the sizing settings come from spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint directory.

    A folder of our own is set only where the session names none (tests).
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="opinara-checkpoint-"))
    return context.getCheckpointDir()


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/opinara/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{_own_scratch(spark)}/{kind}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to its part of the shared folder.

    To be called when a job has stored its results: frames that were not stored read from
    there. Any file system Arrow knows (file, hdfs, s3).
    """
    delete_folder(_own_scratch(spark))


def _file_system(uri: str):
    """The file system of a path as Arrow knows it, and the path there."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/", 1)[0] else (fs.LocalFileSystem(), uri)


def delete_folder(uri: str) -> None:
    from pyarrow import fs

    system, path = _file_system(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def names_in(uri: str) -> list[str]:
    """Names in a folder; one that is not there has none."""
    from pyarrow import fs

    system, path = _file_system(uri)
    return [found.base_name for found in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]


def mark(folder: str, name: str) -> None:
    """An empty file that says something by its name, so it is there whole or not at all."""
    system, path = _file_system(folder)
    system.create_dir(path)
    system.open_output_stream(f"{path}/{name}").close()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    What follows starts from files: it is not recomputed when it is used twice, and a
    lost executor costs no more than its own tasks. Parquet keeps column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what is run inside a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_wide_lineage(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for frames of many or long expressions.

    The JVM never compiles a method of more than 8000 bytes, which Spark generates for them; with this limit
    Spark evaluates them in several methods instead of one.
    """
    with setting(df.sparkSession, "spark.sql.codegen.hugeMethodLimit", "8000"):
        return cut_lineage(df)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder for the time of a block, which must store all it needs.

    The copy goes when the block has ended and stays when it fails. It is compressed harder than
    other tables, and the shuffle files of each job inside go with the job: a merge holds
    one copy of its rows beside those it replaces, not one for every batch and shuffle before.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "staged")
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.parquet(path)
    delete_folder(path)
