"""Spark session helpers.

Cluster settings (executors, memory, ``spark.checkpoint.dir``) come from the
submitting environment.  The helpers here only fill in defaults for local
runs and tests, and never override a value the session already has.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Local-run defaults; on a cluster these come from spark-submit / cluster conf.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "dqspark",
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session for local runs and tests."""
    cores = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cores}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if driver_memory:       # else what the deployment sets
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or int(cores)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file
    system such as HDFS/S3); a machine-local folder is only created when the
    session runs in local mode and nothing is configured.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="dqspark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later
    steps start from a scan, and a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders of this session's ``scratch_dir`` calls; frames that
    read them can't be used afterwards.  Returns their number."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dqspark`` importable on executors (``addPyFile`` of a zip).

    UDF helpers are pickled by reference, so Python workers must import the
    package; on a cluster this is how it reaches them.  Done once per
    SparkContext.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="dqspark-pkg-")      # read by this process alone: addPyFile serves it
    atexit.register(shutil.rmtree, out_dir, ignore_errors=True)
    zpath = os.path.join(out_dir, "dqspark.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
