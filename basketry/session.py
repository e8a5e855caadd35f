"""Session helpers: builder, shared work folder, staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "basketry", cores: str = "*", **settings: str) -> SparkSession:
    """Local session with the settings the engine expects; a cluster passes its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root for tables that cut lineage and for stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. A session without that setting gets it below its
    warehouse, which executors share too, whatever the master.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
        spark.conf.set(CHECKPOINT_SETTING, named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared root, never reused between calls.

    The session owns it: it is deleted when the session's JVM ends. ``drop_folders`` does so at once.
    """
    folder = f"{shared_folder(spark)}/basketry/{purpose}-{uuid.uuid4().hex}"
    files, path = _files(spark, folder)
    files.deleteOnExit(path)
    _FOLDERS.append(folder)
    return folder


_FOLDERS: list[str] = []


def _files(spark: SparkSession, folder: str):
    """File system of a folder, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def drop_folders(spark: SparkSession) -> int:
    """Delete every folder handed out so far; tables staged in them can no longer be read. Returns how many there were."""
    dropped = 0
    while _FOLDERS:
        files, path = _files(spark, _FOLDERS.pop())
        dropped += bool(files.delete(path, True))
    return dropped


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike ``checkpoint()`` the result is columnar, so later passes read only
    the columns they use; unlike ``cache()`` it survives lost executors.
    """
    folder = new_folder(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
