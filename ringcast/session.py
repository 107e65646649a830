"""Session helper for local runs, and staging of intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "ringcast", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("RINGCAST_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ringcast-")
    return _local_dirs[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a columnar table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but later reads still prune columns,
    and a lost executor only costs the tasks it was running.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/ringcast/{app}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
