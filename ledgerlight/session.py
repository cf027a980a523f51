"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str | None = None, app: str = "ledgerlight") -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own settings."""
    cpus = str(cpus or os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application in the one all executors share (``spark.checkpoint.dir``).

    A local session without the setting gets a temporary folder; a cluster
    without it is an error, because a machine-local folder would lose data
    with the machine.  Everything of a run lies below the returned folder, so
    it can be removed when the application has ended.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlight-")
        sc.setCheckpointDir(root)
    return f"{root}/ledgerlight-{sc.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one intermediate table is read by several passes: the copy cuts
    the lineage, survives lost executors and keeps column pruning.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
