"""Session helpers: the shared folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a temporary folder;
    elsewhere the executors could not read what is written there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not base:
        base = context.getCheckpointDir()
    if not base:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tallyloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/tallyloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and go on from the files.

    For loops: unlike a checkpoint, the files do not hand on what the optimizer has concluded about the
    columns, which grows from round to round where they are renamed and joined again.
    """
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a task that parses documents: seconds, not minutes.
TASK_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores in even tasks of bounded size, for parsing that costs far more than moving them.

    Splits of a file follow its row groups, so they may be few, large and uneven."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-df.count() // TASK_ROWS))
    return df if tasks == cores and df.rdd.getNumPartitions() >= cores else df.repartition(tasks)
