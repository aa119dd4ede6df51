"""Intermediate tables in the folder the cluster shares.

A fitted statistic is written once and read back as Parquet. Lineage ends at the
files, so a lost executor costs a re-read and not a second pass over the input.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


#: Folders for masters with one JVM, where no other machine has to reach them; by application.
_LOCAL_FOLDERS: dict[str, str] = {}

#: More bytes than a file has.
WHOLE_FILE = str(1 << 40)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of this machine only on one-JVM masters."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    from_context = spark.sparkContext.getCheckpointDir()
    if from_context:
        return from_context.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(
            f"set {CHECKPOINT_SETTING} to a folder that every executor can reach"
        )
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="rowsmith-")
    return _LOCAL_FOLDERS[application]


def release(spark: SparkSession) -> None:
    """Delete everything this application has written below the shared folder.

    Results that still read these tables must be written elsewhere before.
    """
    folder = f"{shared_folder(spark)}/rowsmith/{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path per call, below one folder per application."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/rowsmith/{application}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_in_tasks(df: DataFrame, name: str, rows: int) -> DataFrame:
    """As ``materialize``, but each task of the returned scan reads one file of at most ``rows`` rows.

    The scan belongs to a session of its own, in which opening a file counts as much as a whole
    task may read; the settings of the caller's session stay as they are.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    by_file = spark.newSession()
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        by_file.conf.set(setting, WHOLE_FILE)
    return by_file.read.schema(df.schema).parquet(path)
