"""Session defaults and the shared folder used for checkpoints and hand-over tables."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def session(app: str = "stockwright", master: str | None = None, **conf) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach. A temporary one is made only on a local master that names none."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors of {sc.master} can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stockwright-"))
    return sc.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/stockwright/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
