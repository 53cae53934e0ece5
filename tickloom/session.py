"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Runtime choices the operators are written for.
RECOMMENDED: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "128m",
    # no call sites per column expression: they slow down building wide plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str, extra: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RECOMMENDED, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tickloom-")
    return _LOCAL_FOLDERS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage.

    For a frame that several branches of a plan read. Lost executors cost no more
    than a read, since the files outlive them.
    """
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
