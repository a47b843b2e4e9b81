"""Session defaults and the shared work folder."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it has at most this many rows; beyond it the
# join is left to the shuffle planner (AQE still converts small runtime sides).
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A scan of at most this many bytes is spread over all cores; larger ones have splits enough.
SPREAD_BYTES = 1 << 30
# Rows of a staged file, and how many reads at most a staged frame is put together from.
FILE_ROWS = 500_000
READS = 64


def local_session(app: str = "tabsift", cpus: int | str = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    A local session (tests, laptops) that names none gets one made here; on a
    cluster a folder of one machine would lose rows, so that is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabsift-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tabsift/{label}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """Use every core on few bytes in few splits; larger scans pass unchanged, however many cores there are."""
    if planned_bytes(scan) > SPREAD_BYTES:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def planned_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def staged(df: DataFrame, label: str, dealt: bool = False) -> DataFrame:
    """Write a frame that several jobs will read, and go on from the written table.

    It cuts the lineage in a folder that outlives any executor, and later jobs
    read only the columns they need. It is written once, a small one with a file
    per core, and read back in file order, so seeded draws repeat at any size.
    Files hold FILE_ROWS rows at most, and one read packs all of them into a task
    per core: a frame of more files than cores is put together from several reads,
    so that a task holds about one file's rows, however well they compress.
    A frame of shuffles that is ``dealt`` already is written as it lies: asking
    for its number of partitions would run the shuffles once more.
    Old folders may be expired by the cluster.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    (df if dealt else spread(df)).write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    files = sorted(back.inputFiles())
    if not files:
        return back
    reads = min(READS, -(-len(files) // spark.sparkContext.defaultParallelism))
    return reduce(DataFrame.unionAll, [spark.read.schema(df.schema).parquet(*files[i::reads]) for i in range(reads)])


def released(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove the folders of staged frames that nothing reads again, and let go of the shuffle files of finished jobs.

    Spark's cleaner removes those once the driver's garbage is collected, Python's first, as it holds on to Java's.
    """
    gc.collect()
    for folder in sorted({f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_methods(spark: SparkSession):
    """Jobs with many wide expressions: the JVM never compiles a method of over 8,000 bytes, so Spark is told to make several."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, 8_000)
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side only after its rows were counted and found few and narrow.

    The counted rows are kept, as a broadcast would fetch them anyway, so the
    side is computed once. A larger side is left to a shuffle join.
    """
    width = 8 * max(1, len(df.columns))
    found = df.limit(min(rows, BROADCAST_BYTES // width) + 1).collect()
    bytes_held = sum(len(v) if isinstance(v, (str, bytes)) else 8 for r in found for v in r)
    small = len(found) <= rows and bytes_held <= BROADCAST_BYTES
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema)) if small else df


def one_row(df: DataFrame):
    """A one-row aggregate as a scalar sub-query: ``one_row(stats)["p99"]``.

    It replaces the one-row cross join: the value reaches executors as a
    literal, and Spark fails the query if the frame ever has two rows.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).scalar()
