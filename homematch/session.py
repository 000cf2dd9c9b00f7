"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "homematch", master: str | None = None, **conf: object) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and UTC time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def is_one_machine(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[8]``)."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a local session gets a temporary folder that goes when
    the process ends; a cluster session gets an error, since a folder of one
    machine would lose what the others write.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not is_one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="homematch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path under the shared folder, never used before; deleted when the session's process ends."""
    path = f"{shared_folder(spark)}/homematch/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def saved(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Later steps read only the columns they need and survive lost executors.
    With ``rows_per_file`` a file holds at most so many rows: Spark deals files
    to tasks by bytes, so few tasks would read rows that compress well.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
