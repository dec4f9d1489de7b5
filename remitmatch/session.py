"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any size; a cluster's own values for memory, cores and
# shuffle partitions stay as they are.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "remitmatch", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the engine's settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that driver and executors share.

    The folder is the one named in ``spark.checkpoint.dir``. Where the session names none, a
    temporary folder is made and recorded there, but only if driver and executors are one process
    (``local[...]``, as in tests); on a cluster it would be a different folder on every machine, so
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="remitmatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"remitmatch-{uuid.uuid4().hex}", name)


# How tables are packed that this engine writes and reads again.
PACKED = "zstd"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=PACKED)
    return df.sparkSession.read.schema(df.schema).parquet(path)
