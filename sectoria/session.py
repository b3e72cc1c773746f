"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark's option to remove the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; on a cluster use the session the cluster hands out."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sectoria")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Small data: keep all cores busy instead of merging little partitions and files into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "65536")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing shared folder is an error.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="sectoria-checkpoint-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files; otherwise these stay until the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    The stored table survives the loss of any executor, later passes read only
    the columns they need, and its size is known to the optimizer. What was
    exchanged to form the rows is removed as soon as they are stored.
    """
    path = shared_folder(df.sparkSession, "etape")
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Fixed rows as a local relation, whose known size lets the optimizer broadcast it."""
    names = T.StructType.fromDDL(schema).names
    columns = {name: list(values) for name, values in zip(names, zip(*rows, strict=True), strict=True)}
    return spark.createDataFrame(pa.table(columns)).to(T.StructType.fromDDL(schema))


def shared_folder(spark: SparkSession, name: str) -> str:
    """New folder below the shared checkpoint folder, for tables handed from one step to the next."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"
