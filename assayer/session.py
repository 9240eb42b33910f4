"""Session set-up and the shared folder for tables that outlive a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("assayer")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a fresh temporary
    folder: there the driver's disk is every executor's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="assayer-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used for learned tables that several later plans read: it cuts lineage,
    survives lost executors, and gives Catalyst true sizes, so a later join
    broadcasts the table only if its files fit ``autoBroadcastJoinThreshold``.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``settle`` wrote, when no plan will read it again."""
    spark = table.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in table.inputFiles()}
    for folder in folders:
        if f"/{spark.sparkContext.applicationId}/" not in folder:
            raise ValueError(f"{folder} was not written by settle")
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
