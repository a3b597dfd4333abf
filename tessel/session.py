"""Session helpers: a local session for tests/bench and the checkpoint directory rule.

Library code never invents storage on a cluster: iterative operators cut
lineage with ``DataFrame.checkpoint()`` into the directory the cluster names in
``spark.checkpoint.dir``.  Only when that is unset *and* Spark runs in local
mode do we fall back to a fresh folder under the system temp dir.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessel") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the directory it writes to."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared (HDFS/S3/...) folder: iterative operators "
            "checkpoint there to survive executor loss"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessel-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet into the shared folder and read it back: ``(table, path)``.

    Cuts lineage like ``checkpoint()``, but runs the plan once with adaptive execution and
    leaves a columnar table, in a folder for each value of ``partition_by`` where that is given.
    Pass the path to ``discard`` when nothing will read it again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later action reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that nothing refers to any more.

    Its cleaner works when the driver collects garbage, which a driver that holds little data
    seldom does; a job of many steps calls this after each so that their shuffles do not pile up.
    What Python gives up reaches the JVM with a later call, hence two rounds.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
