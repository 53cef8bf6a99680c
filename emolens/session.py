"""Session helpers.

The library never creates its own session inside an operator: every operator
takes DataFrames (or a ``SparkSession``) from the caller.  ``local_session`` is
only for tests, the bench and the smoke entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "emolens") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("EMOLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local session without one (tests) gets a scratch folder;
    on a cluster executors could not share it, so a missing setting is an
    error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="emolens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def folder_stamp(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of a folder's files (two levels deep): tables
    derived from them are reused only while it stays the same."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(path):
        for f in fs.listStatus(s.getPath()) if s.isDirectory() else [s]:
            found.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder.

    Used for tables that are re-read many times (fold feature tables in a
    grid search) so that a lost executor does not replay the whole plan.  It
    is written as compressed Parquet, a fraction of the rows that a checkpoint
    writes, and the shuffle files of the job are removed when it is written:
    nothing reads them again.
    """
    spark, clean = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)
