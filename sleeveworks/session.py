"""Session settings the library needs, and the shared folder it may write to."""

import re
import uuid

from pyspark.sql import SparkSession

# Runtime settings that results or skew handling depend on.
RUNTIME = {
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sleeveworks")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which must be on a file system that the executors share: a
    warehouse on the driver's own disk is refused unless the session runs on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if not folder and not local and re.match("(file:|/)", spark.conf.get("spark.sql.warehouse.dir")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_made: dict[str, list[str]] = {}


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody used before; ``clear_shared`` removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_shared(spark: SparkSession) -> None:
    """Remove what this application put below the shared folder. Frames that read it are then void."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _made.pop(spark.sparkContext.applicationId, []):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
