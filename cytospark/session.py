"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cytospark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling switched on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a single-machine
    session may leave that unset; it gets a local temporary folder. Executors on
    other machines could not see one, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not single_machine(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    fallback = getattr(scratch_root, "_local", None)
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="cytospark-")
        atexit.register(shutil.rmtree, fallback, ignore_errors=True)
        scratch_root._local = fallback
    return fallback


def session_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables go."""
    return f"{scratch_root(spark)}/cytospark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables.

    For the end of a run, once its results are written: frames that operators
    returned may still read them.
    """
    discard(spark, session_folder(spark))


def durable(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage and survives the loss of executors, unlike a cache.
    """
    return stored(df, name, partition_by)[0]


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None, session: SparkSession | None = None) -> tuple[DataFrame, str]:
    """``durable`` and the folder, for loops that ``discard`` the table of the turn before. ``session`` reads it, else that of the frame."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path), path


def without_shuffles(spark: SparkSession) -> SparkSession:
    """A session of the same settings whose jobs delete their shuffles as they end.

    For loops of many jobs: else shuffles stay on disk until the driver happens to collect its garbage. A frame of this session
    is run once, as its plan keeps what it has shuffled.
    """
    tidy = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if tidy.conf.get(key, None) != value:
            tidy.conf.set(key, value)
    tidy.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return tidy


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
