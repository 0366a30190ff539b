"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so that they can be applied to a session somebody else made.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join below an aggregate on the same keys is split too, at the price of one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Documents are large rows: bound an Arrow batch by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that the operators count on; safe to call again."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set, as in local tests."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="quillstream-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, path: str, **options: str) -> str:
    """Write `df` as a table, packed closely, and give back at once the disk of the shuffles that its write made.

    A write is planned anew, so nothing reads its shuffles once it has ended. Left to the driver's garbage collector, those of
    all writes of a long job lie on the executors' disks together.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(compression="zstd").options(**options).parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return path


def settled_path(df: DataFrame, **options: str) -> str:
    """Write `df` as a table in the checkpoint folder. The session that named the folder owns its clean-up."""
    return written(df, f"{checkpoint_folder(df.sparkSession).rstrip('/')}/settled-{uuid.uuid4().hex}", **options)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that `settled_path` wrote, when what was made of it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once; later uses read its table, which outlives the executors that wrote it."""
    return df.sparkSession.read.schema(df.schema).parquet(settled_path(df))
