"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that the plans rely on; a cluster's own choices win, apart from the time zone.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("histrail")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histrail-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the program was started: once an application, as a small archive."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="histrail-ship-")) / "histrail.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


_made: list[tuple[SparkSession, str]] = []


def _sweep() -> None:
    for spark, path in _made:
        try:
            remove(spark, path)
        except Exception:  # the JVM has gone; the folder's owner cleans up
            return


atexit.register(_sweep)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; it is removed when the program ends."""
    path = f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. Survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """For work that is heavy on the CPU: an input of fewer splits than half the cores is spread over all of them. What is
    shuffled then is a few splits; an input of many splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
