"""Session, scratch space and spreading."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def build_session(app: str = "storyloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans assume. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # call-site capture doubles the time to build a large expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="storyloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


# Bytes of files that one task is dealt at most, about.
PART_BYTES = 16 << 20


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop_path).getLength()


def parts_for(spark: SparkSession, size: int) -> int:
    """Tasks for ``size`` bytes of files: all cores, and more where one would get over ``PART_BYTES``."""
    return max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))


def spread(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Deal the rows over ``parts`` tasks (all cores) by ``key``: one shuffle, for the caller to ask for.

    Of use where a file has one row group and so one busy task. Hash on the key
    keeps the placement the same when a task is run again. ``parts_for`` keeps tasks of one size however large the files are.
    """
    return df.repartition(parts or df.sparkSession.sparkContext.defaultParallelism, key)
