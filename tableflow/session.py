"""Session set-up and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "tableflow", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """Return a session with adaptive execution on; ``settings`` win over the defaults here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    Only a local session without the setting gets a temporary folder; a cluster without it is an
    error, since a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def materialise(df: DataFrame, reader: SparkSession | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (in the session ``reader``, if given).
    ``codec`` is the compression of the files, if not that of the session.

    Cuts the lineage like ``checkpoint()`` does, but stays columnar, so later steps still prune
    columns and push filters. The rows survive the loss of any executor. The shuffle files of the step
    go once it is written.
    """
    path = f"{shared_folder(df.sparkSession)}/tableflow/{uuid.uuid4().hex}"
    schema = df.schema
    before = df.sparkSession.conf.get(_CLEANUP_SETTING, "false")
    df.sparkSession.conf.set(_CLEANUP_SETTING, "true")
    try:
        df.write.mode("errorifexists").parquet(path, compression=codec)
    finally:
        df.sparkSession.conf.set(_CLEANUP_SETTING, before)
    return (reader or df.sparkSession).read.schema(schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Empty the folders of frames that ``materialise`` has given and that nothing will read again, so
    that the steps of a long job do not all lie on disk together."""
    for df in frames:
        files = df.inputFiles()
        if files:
            empty = df.sparkSession.createDataFrame([], df.schema)
            empty.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])
