"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(
    app: str = "veristream", master: str | None = None, initial_partitions: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster leave ``master`` to spark-submit.  Adaptive execution joins
    small shuffle partitions at run time and splits skewed join partitions; it never
    makes more partitions than there were at first, so give ``initial_partitions``
    for large data: the largest shuffle's bytes by 128 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k: str(v) for k, v in conf.items()},
    }
    if initial_partitions is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executor are one process, may go
    without: it gets a temporary folder, one per application.  On a cluster
    executors would not see each other's files there, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="veristream-")
        root = _OWN_ROOTS[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{scratch_root(spark)}/veristream/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and lets
    later plans see true sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Characters of text for one task of work that makes many rows of each.
TASK_CHARS = 8_000_000


def tasks_for(df: DataFrame, text: str, at_least: int = 1) -> int:
    """How many tasks the texts of ``df`` want, by their length: no task grows with the input.  Reads ``text`` once."""
    chars = df.agg(F.sum(F.length(text).cast("bigint"))).first()[0] or 0
    return max(at_least, -(-chars // TASK_CHARS))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt to ``partitions`` tasks before work that is heavy per row; as they are if it is None.

    A scan makes no more tasks than its files have parts: a caller that knows its input to be
    one small file passes the number of cores.
    """
    return df if partitions is None else df.repartition(partitions)
