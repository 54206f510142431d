"""Session helpers: the checkpoint folder and scale-dependent partition counts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(master: str = "local[*]", app: str = "docpipe", **conf: str) -> SparkSession:
    """A session with the settings every operator assumes: UTC, AQE and skew-join handling on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # files of what nothing refers to any more
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in spark.checkpoint.dir; a temporary one is made only in local mode.

    On a cluster without that setting this raises: a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="docpipe-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SMALL_INPUT = 1 << 30  # bytes


def spread_out(df: DataFrame) -> DataFrame:
    """df, redistributed over the session's cores if the files it is read from are fewer than these and below SMALL_INPUT in all.

    For work that costs far more per byte than moving the rows does. A large table, and what reads no files, is left as it lies.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not files or len(files) >= cores:
        return df
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    size = sum(path(f).getFileSystem(conf).getFileStatus(path(f)).getLen() for f in files)
    return df.repartition(cores) if size < SMALL_INPUT else df


REPEAT_BUCKETS = 1 << 20


def once_per_key(df: DataFrame, keys: list[str], value: str, buckets: int = REPEAT_BUCKETS) -> DataFrame:
    """keys and value, one row per key, moving only the values of keys that are met more than once (the smallest value stands).

    Repeated keys are found on keys alone and kept as hash buckets, at most `buckets` numbers, which are broadcast. All
    rows of such a bucket are grouped; the others stay where they are. Keys must not be null. Counts the repeats at once.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket")
    twice = cut_lineage(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(bucket).distinct())
    base = df.select(*keys, value)
    if twice.isEmpty():
        return base
    marked, twice = base.withColumn("__bucket", bucket), F.broadcast(twice)
    single = marked.join(twice, "__bucket", "left_anti").select(*keys, value)
    repeated = marked.join(twice, "__bucket", "left_semi").groupBy(*keys).agg(F.min(value).alias(value))
    return single.unionByName(repeated.select(*keys, value))


