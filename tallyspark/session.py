"""Session settings and the shared folder that written tables go to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app="tallyspark", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOT: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach. A machine-local folder is used only by a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        path = tempfile.mkdtemp(prefix="tallyspark-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _LOCAL_ROOT[app] = path
    return _LOCAL_ROOT[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A folder name below the shared root that nothing has used yet."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared folder and read it back with its known schema and size."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
