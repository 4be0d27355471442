"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

HOT_KEY_ROWS = "spark.recurra.hotKeyRows"


def build_session(app: str = "recurra", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and timestamps pinned to UTC."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        # Call-site tracking costs a round trip per expression while plans are built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Plans name the whole path of what they read, however deep its folder is.
        "spark.sql.maxMetadataStringLength": "1000",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local session without the setting gets a scratch folder of its own; a cluster
    session without it is refused, since a driver-local folder would lose the data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="recurra-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where a later step must see exactly these rows again (range boundaries and
    partition numbers are fixed once written) and to make a lost executor cheap.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/recurra-{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
