"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings the loads rely on. Sizes that depend on the cluster (executors,
# memory, initial shuffle width) belong in conf/cluster.conf, not in code.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a grouping after it then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # The JVM does not compile methods beyond 8,000 bytes of byte code, so wide
    # generated stages would be interpreted; this runs them operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables that are moved together share the cluster evenly, each in a pool of its own.
    "spark.scheduler.mode": "FAIR",
}

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "tableferry", **conf: str) -> SparkSession:
    """Session with the defaults above; the master comes from spark-submit unless given in ``conf``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged copies and checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where driver and executors are one machine, may fall back to a temporary
    folder, which is removed when Python exits.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="tableferry-")
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below this application's own folder in the scratch root (see ``leases``)."""
    from tableferry.leases import run_folder

    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def has_source(spark: SparkSession, name: str) -> bool:
    """True when a data source of this name is on the classpath."""
    lookup = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
    try:
        lookup.lookupDataSource(name, spark._jsparkSession.sessionState().conf())
        return True
    except Exception:
        return False


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A frame without rows that is planned away, unlike one made from an empty Python list."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def text_frame(spark: SparkSession, lines: list[str]) -> DataFrame:
    """A few lines as a column ``value``, held in the plan."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, lines))).alias("value"))
