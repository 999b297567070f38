"""Session settings, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every plan relies on.  UTC pins the wall clock of zone-less
# event times; AQE coalesces small shuffles, splits skewed joins and picks
# broadcast joins from measured sizes.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffle files go once their query has ended; otherwise they stay until the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024
SHUFFLE_EXPANSION = 16      # rows in memory, keys and derived columns included, take up to so many times their file
SCAN_SPLIT_BYTES = 32 * 1024 * 1024

# Sizes of what one task takes, at most.  Dedup sorts what a scan task holds before the first shuffle, and rows without a
# key meet in one partition of an outer join, which AQE splits from the threshold on; both have to fit as rows.
CEILINGS = {
    "spark.sql.files.maxPartitionBytes": SCAN_SPLIT_BYTES,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 * 1024 * 1024,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 * 1024 * 1024,
}
SHUFFLE_CEILING = 100_000

_scratch_roots: dict[str, str] = {}


def build_session(app_name: str = "plantlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **RUNTIME, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    for key, most in CEILINGS.items():
        spark.conf.set(key, str(min(most, _bytes(spark, key))))
    return spark


def _bytes(spark: SparkSession, key: str) -> int:
    """A size setting in bytes, whatever unit it was given in."""
    text = spark.conf.get(key)
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def shuffle_partitions_for(input_bytes: int, parallelism: int) -> int:
    """Initial shuffle width for an input of this size.

    AQE merges small reduce partitions but never adds any, so the initial
    number has to fit the data: about 256 MB per partition, at least one per
    core, and a ceiling that keeps map-output metadata in the driver's memory
    (1 GB of input per partition at 100 TB, of which a shuffle moves a part).
    """
    wanted = math.ceil(input_bytes / SHUFFLE_TARGET_BYTES)
    return max(parallelism, min(wanted, SHUFFLE_CEILING))


def input_bytes(spark: SparkSession, path: str, pattern: str = "*") -> int:
    """Total file size under ``path`` as it is now; only file metadata is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return int(files.agg(F.sum("length")).first()[0] or 0)


def size_shuffles(spark: SparkSession, path: str, pattern: str = "*") -> int:
    """Set ``spark.sql.shuffle.partitions`` from the size of the input folder, as rows in memory."""
    width = shuffle_partitions_for(
        SHUFFLE_EXPANSION * input_bytes(spark, path, pattern), spark.sparkContext.defaultParallelism
    )
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return width


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    ``spark.checkpoint.dir`` (or a directory already set on the context) is
    used as given.  Only a local session without one gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _scratch_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _scratch_roots[app] = tempfile.mkdtemp(prefix="plantlens-")
        spark.sparkContext.setCheckpointDir(_scratch_roots[app])
    return _scratch_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; never reused, so reruns cannot clash."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *, partition_by: tuple[str, ...] = (), codec: str = "snappy") -> DataFrame:
    """Written to the shared folder and read back.

    Unlike a checkpoint, whose estimated size is that of the plan behind it (a
    join's is the product of its sides, so it squares with every round of a
    loop), the result has the size of its files.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, one: Callable, items: Iterable, parallel: int = 8) -> list:
    """``one(item)`` for every item, a few at a time, in threads of the session.

    Each call has local properties of its own: Spark keeps the number of the
    running query there, and calls that share them take it from each other.
    """
    calls = [(inheritable_thread_target(spark)(one), item) for item in items]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(lambda call: call[0](call[1]), calls))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this run that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
