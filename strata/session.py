"""Session helpers.

``local_session`` is for tests and the bench only; library code never
builds or reconfigures a session.  ``shared_path`` hands out folders under
the cluster-wide ``spark.checkpoint.dir`` so written tables and checkpoints
survive executor loss.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "strata", driver_memory: str = "8g") -> SparkSession:
    """A local session tuned for small-scale verification runs."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder (``spark.checkpoint.dir``).

    Only a single-machine session (master ``local[...]``) without the setting
    gets a scratch folder of its own, as in tests.  On a cluster the setting
    must name a folder that all executors share; without it this raises,
    because a machine-local folder would lose what other executors wrote.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read back, and its path."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used before iterative fits: later jobs (and a lost executor's retries)
    start from the written table instead of the whole lineage.  Parquet is
    columnar and keeps ML column metadata; never a local checkpoint.  The
    table must outlive the returned plan, so it stays until the application's
    shared folder is cleared; loops that replace a table call ``discard``.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int, placed: bool = False) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, bucketed by ``column``, and the table's name.

    A join or grouping by ``column`` with as many partitions reads the table where
    it lies, without an exchange.  ``placed``: the rows come from such a join already and
    aren't dealt out again.  ``drop_bucketed`` removes it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    rows = df if placed else df.repartition(buckets, column)
    (rows.write.mode("overwrite").bucketBy(buckets, column)
     .option("path", path).format("parquet").saveAsTable(table))
    return spark.table(table), table


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Remove a table made by ``bucketed`` and its files."""
    where = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {table}")
    discard(spark, where)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table written by ``written`` that no later plan reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_width(spark: SparkSession, default: int = 200) -> int:
    """Current shuffle partition count, used to size salts."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # pragma: no cover - conf always present in practice
        return default


def cluster_cores(spark: SparkSession) -> int | None:
    """Default parallelism (total executor cores); None when not exposed."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # sessions without a SparkContext
        return None


def task_heap(spark: SparkSession) -> int | None:
    """Bytes of heap that a task has if all cores of its executor are busy; None when not exposed."""
    try:
        sc = spark.sparkContext
        status = sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().getExecutorMemoryStatus())
        own = {at: int(status[at]._1()) for at in status}  # bytes for Spark's own use, of the driver too
        if len(own) > 1:
            own.pop(sc._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort(), None)
        fraction = float(sc.getConf().get("spark.memory.fraction", "0.6"))
        return int((min(own.values()) / fraction + (300 << 20)) * len(own) / max(1, sc.defaultParallelism))
    except Exception:  # sessions without a SparkContext
        return None
