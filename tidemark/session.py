"""Session helpers: builder, shared folder for stored intermediates, materialisation."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: dict[str, str] = {}


def build_session(name: str = "tidemark", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for stored intermediates: spark.checkpoint.dir; a fresh one only for local runs without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dir:
        _local_dir[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dir[app]


def materialise(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write once, read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    tag = f"{name or 'step'}-{uuid.uuid4().hex[:12]}"
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, key: str, name: str, clustered: bool = False, buckets: int | None = None) -> DataFrame:
    """Store hash-bucketed by one key, so later windows and joins on that key need no exchange.

    clustered: df already left an exchange on the key, so every bucket sits in one task without another shuffle.
    """
    spark = df.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets or 1 << 30)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{table}"
    ((df if clustered else df.repartition(n, key)).write.bucketBy(n, key).option("path", path)
       .format("parquet").saveAsTable(table))
    return spark.table(table)
