"""Session helpers.

``build_session`` gives the settings every test and the bench use: UTC session
time, AQE with partition coalescing and skew-join splitting, no UI.

``shared_dir`` is the only place this library writes: the folder the cluster
names in ``spark.checkpoint.dir``.  Where that setting is missing, a local
master gets a temp folder of its own and a cluster gets an error.

``ship_package`` sends this package to the executors, so that functions that
run in Python workers can be imported there.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fileflow", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of collected RDDs are removed (they live in shared storage)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of this application (``spark.checkpoint.dir``).

    Reads the setting from the session.  Where it is unset, a local master gets
    a fresh temp folder (as in tests); on a cluster executors could not see
    such a folder, so that is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base is None:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            if not is_local(spark):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            conf_dir = tempfile.mkdtemp(prefix="fileflow-ckpt-")
        sc.setCheckpointDir(conf_dir)
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def is_local(spark: SparkSession) -> bool:
    """Whether the driver and the executors are one process (``local[...]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fileflow`` importable on the executors (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="fileflow-ship-"), "fileflow-pkg")
    # Spark's file server hands the archive to every executor
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root)))
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/fileflow/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to the shared folder and read back; values of the columns ``by`` have folders of their own."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_listing_tasks(spark: SparkSession):
    """Scope in which Spark lists many folders in a few tasks a core; its default is a task a folder, up to 10,000."""
    return session_conf(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=8 * spark.sparkContext.defaultParallelism)


@contextlib.contextmanager
def session_conf(spark: SparkSession, **settings):
    """Set session confs (dotted keys passed with '__' for '.') and restore them.

    File split sizes are read when a scan is *planned*, i.e. at the action:
    run the action inside the block.
    """
    keys = {k.replace("__", "."): str(v) for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

