"""Session helpers: local session for tests and benches, reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "tillwork") -> SparkSession:
    """A local session. On a cluster the caller's own session is used instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local session may fall back to a folder on this
    machine; a cluster without the setting is an error, since executors could not read it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tillwork-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For loops: a checkpoint keeps the size that the optimizer estimated, a join multiplies the
    estimates of its sides, and a few rounds of joins make them numbers of millions of digits.
    A table has the size of its files.
    """
    spark = df.sparkSession
    target = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def over_cores(df: DataFrame) -> DataFrame:
    """A materialised ``df`` in at least as many partitions as the cluster runs tasks at once.

    Joins of little data end in few partitions; heavy passes over them would leave cores idle.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)
