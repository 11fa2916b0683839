"""Session settings and the shared folder used for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on.  Everything else is left to the cluster.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("burnish")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SEMANTIC_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on, on a session made elsewhere."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _one_machine(spark: SparkSession) -> bool:
    """Local modes, local-cluster included, run every executor on this machine."""
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Where the setting is missing, a folder set on the context is used; only a
    local-mode session without either gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder and re.match(r"(file:/*)?/?(tmp|var/tmp)/", folder.lstrip("/")) and not _one_machine(spark):
        warnings.warn(f"{folder} looks local to each machine; name a folder all executors share", stacklevel=2)
    if not folder:
        if not _one_machine(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="burnish-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached frame the copy survives lost executors, and being columnar a
    later pass reads only the columns it needs.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
