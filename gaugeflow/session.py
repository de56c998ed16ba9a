"""Session settings the operators rely on, and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; all can be changed on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs; anything else is left to the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "12g") -> SparkSession:
    """Session for tests and the local benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gaugeflow")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_OWN_DIR: dict[str, str] = {}  # per application, where the session names no folder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a master within one process may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN_DIR:
        _OWN_DIR[application] = tempfile.mkdtemp(prefix="gaugeflow-")
    return _OWN_DIR[application]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small input as many partitions as there are cores, for steps that compute a lot per row.

    Inputs with enough partitions, hence all large ones, are left as they are: no shuffle is added.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps use and read it back.

    The steps then share one computation, start from columnar files with statistics, and don't
    depend on executors that may be gone. The files stay in the shared folder until ``discard``.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path)[0].exists(_files(spark, path)[1])


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def _files(spark: SparkSession, path: str):
    """The file system of a path, in whatever store it is, and the path in it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads: results built on them must be written or staged themselves."""
    for df in frames:
        delete_path(df.sparkSession, df.staged_at)
