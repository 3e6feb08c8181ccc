"""Session helpers: a tuned local/cluster session, and tables in the shared
checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "curato") -> SparkSession:
    """Return a session tuned for the selection jobs.

    On a cluster the master and most sizing come from ``spark-submit``; the
    settings here switch on adaptive execution (runtime coalescing, skew join
    splitting), restrict broadcasts to sides measured at run time, and keep
    the web UI off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only on measured sizes: no estimate-based broadcast at
        # planning time; AQE broadcasts a side whose shuffle output it has
        # measured under the threshold.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10485760b")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # Local mode runs every task in the driver JVM: give it the memory an
        # executor would have (only takes effect when this call starts the JVM).
        builder = builder.config("spark.driver.memory", os.environ.get("CURATO_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    if master and master.startswith("local"):
        # Python workers of a local session find this package wherever they are started;
        # a cluster gets it by --py-files or its image, as usual.
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is. Only a local-mode session without one (tests, benches) gets a fresh
    scratch folder, because a machine-local folder is useless to a cluster.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; staged tables need a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder for checkpoints")
        configured = tempfile.mkdtemp(prefix="curato-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{os.urandom(6).hex()}"
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


_SCOPE: ContextVar[list[str] | None] = ContextVar("tables", default=None)


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, every intermediate table made inside.

    Operators return lazy DataFrames that read their staged tables, so a table may go
    only when its results have been written or collected: do both inside the scope.

        with table_scope(spark):
            some_operator(df).write.parquet(target)
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        drop_tables(spark, paths)


#: When set to a list, ``stage`` appends (name, physical plan) to it: the plan
#: tools show every segment of a query, not only what follows the last table.
STAGED_PLANS: list[tuple[str, str]] | None = None


def stage(df: DataFrame, name: str, record: list[str] | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table under the shared folder.

    Used where several steps read a relation, or must see exactly the same
    rows in the same partitions.  The table is columnar, so a later step still
    reads only its columns, and a lost executor costs a re-read, not a rerun.
    ``record`` receives the path, for ``drop_tables``."""
    path = scratch_path(df.sparkSession, name)
    if STAGED_PLANS is not None:
        STAGED_PLANS.append((name, df._jdf.queryExecution().executedPlan().toString()))
    df.write.parquet(path)
    if record is not None:
        record.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables, wherever their file system is."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
