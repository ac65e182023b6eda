"""Session defaults and lineage cuts.

Intermediate tables are written under the folder the cluster names in
``spark.checkpoint.dir``; only a local-mode session without that setting gets a
temporary folder of its own (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "cinerank", driver_memory: str = "16g") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, read from the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="cinerank-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


# Tables written by `materialize`, per application, for `cleanup`.
_WRITTEN: dict[str, list[str]] = {}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written files, not from the
    source scan) and gives later joins real size statistics.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/cinerank/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)  # also of a write that fails
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Tables in the session's catalog over bucketed files, per application, for `cleanup`.
_TABLES: dict[str, list[str]] = {}


def materialize_by(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``materialize``, with the files bucketed and sorted by ``key``.

    Joins, aggregations and windows by the key read them without an exchange.  The files lie under
    the checkpoint folder; the session's catalog only holds their bucketing.  ``buckets`` defaults
    to the session's shuffle partitions; one task writes each bucket.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = uuid.uuid4().hex
    path, table = f"{checkpoint_root(spark)}/cinerank/{name}-{tag}", f"cinerank_{name}_{tag}"
    app = spark.sparkContext.applicationId
    _WRITTEN.setdefault(app, []).append(path)
    _TABLES.setdefault(app, []).append(table)
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def cleanup(spark: SparkSession) -> int:
    """Delete the tables this application wrote with ``materialize`` and ``materialize_by``; returns how many.

    Call it once the results built on them have been written or collected.
    """
    for table in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(p)
        jpath.getFileSystem(conf).delete(jpath, True)
    return len(paths)
