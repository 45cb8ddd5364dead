"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings every pipeline relies on; all of them can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "sensorloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """A frame without rows that the optimizer knows to be empty."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A stored table, or no rows where nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, schema)


def work_root(spark: SparkSession) -> str:
    """The folder all executors share: what the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session whose tasks all run in the driver's own process gets a temporary
    folder, removed at the end; elsewhere that would be lost with its machine, so it is an error.
    """
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared:
        return shared.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context._jsc.sc().isLocal():
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="sensorloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
