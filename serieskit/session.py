"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "serieskit", cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. On a cluster pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a local one only in local mode."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="serieskit-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Used where a result feeds several later jobs: a lost executor then costs a re-read
    instead of a recomputation, and later jobs read only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[str], by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Like ``materialize``, as a table in folders by the columns ``by``, in buckets by ``keys``, each file sorted by ``order``.

    A later group, window or join on ``keys`` (or on more columns) reads its buckets in place, without an exchange; a
    condition on ``by`` reads only its folders. Without ``buckets`` there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"laid_out_{uuid.uuid4().hex}"
    # Rows are dealt as the buckets are, so that a folder has one file for each bucket.
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*order)
    writer = writer.partitionBy(*by) if by else writer
    writer.format("parquet").option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)
