"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings the plans assume. AQE re-plans joins (broadcast only after the
# runtime size check), coalesces small shuffle partitions and splits skewed
# join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "arealens") -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only applied when given (tests / bench); on a cluster the
    launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Without one a session on a cluster is
    refused; only a session of one process (tests) gets a folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not fallback and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = fallback or os.path.join("/tmp", "arealens-checkpoints")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back.

    Cuts the lineage (like a reliable checkpoint) with a single write job;
    the copy is what every later branch reads, so nondeterministic columns
    (partition ids, sampled bounds) are fixed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy._scratch_path = path
    return copy


def discard(copy) -> None:
    """Remove the files of a ``materialize`` copy whose last reader is done."""
    path = getattr(copy, "_scratch_path", None)
    if path:
        jvm = copy.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(copy.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
        copy._scratch_path = None
