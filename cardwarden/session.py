"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "cardwarden", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
        if master.startswith("local"):
            builder = (
                builder.config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.memory", "8g")
            )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All time arithmetic is defined in UTC, whatever session the caller hands over."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster the executors
    could neither see it nor recover from it, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = sc.getCheckpointDir()
        if not root:
            root = "file:" + tempfile.mkdtemp(prefix="cardwarden-")
            sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name for one table below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def setting(spark: SparkSession, name: str, default: int) -> int:
    """``cardwarden.<name>`` of the session. Such settings move work between plans, never a result."""
    return int(spark.conf.get(f"cardwarden.{name}", str(default)))


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and cut its lineage there."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Like :func:`settle`, but as Parquet, so later reads prune columns and partitions."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the workers this package, once per application, so that they need no copy of their own."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="cardwarden-code-"), "cardwarden.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark
