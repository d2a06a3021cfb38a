"""Session helpers: a local session for tests, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paralane")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where the session names none, as in tests, is a new folder made for it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="paralane-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_MADE: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet; ``remove_materialized`` knows it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete what was written to a ``new_folder`` path, once nothing reads it any more."""
    if path in _MADE:
        _MADE.remove(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small table over all cores before work that is heavy for its size.

    A table that is already read in as many partitions as there are cores is left alone, so
    large tables are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute a table once, now, so that operators that read it twice or thrice reuse it.

    It is written as Parquet, so it outlives lost executors, and a later scan reads only the columns
    that it needs. A caller who names the ``path`` owns the files. Otherwise they go to a new place
    in the shared folder and stay until ``remove_materialized``.
    """
    if path is None:
        path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_materialized(spark: SparkSession) -> int:
    """Delete the tables that this session has put into the shared folder.

    To be called when no result that reads them is needed any more. Returns how many there were.
    """
    count = len(_MADE)
    while _MADE:
        remove_folder(spark, _MADE[-1])
    return count
