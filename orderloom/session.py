"""Session settings used by tests and the benchmark, and the shared work folder."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The default of 128 groups makes nearly every collect_list sort its input.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", name: str = "orderloom", **extra: str) -> SparkSession:
    """A local session; ``extra`` should name a ``spark.checkpoint.dir``. On a cluster the
    caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    A local session without the setting uses a folder in its warehouse; a cluster
    without it is an error, because a machine-local folder dies with its machine.
    """
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getCheckpointDir())
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, removed when the application ends."""
    name = "/".join([shared_folder(spark), purpose, uuid.uuid4().hex])
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path that a job has written to its end."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return [n for n in names if files.exists(_file_system(spark, f"{path}/{n}/_SUCCESS")[0])]


def delete_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


#: Codec of what is kept or landed: about a third smaller than the default for text rows.
KEPT_CODEC = "zstd"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: the result no longer depends
    on recomputation, so ids taken from partitions survive lost executors."""
    path = new_folder(df.sparkSession, purpose)
    df.write.option("compression", KEPT_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
