"""Results of one run of a job, visible to readers only once they are complete.

Every part is written below ``<path>/<run_id>/<name>``; the manifest, with each part's schema and row count, is written
last. Row counts are observed while a part is written. Readers go by the manifest: a run without one does not exist
for them, and a part whose rows don't match it is an error. A repeated run replaces its parts, the manifest last.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.sources.report_files import read_report, write_report

MANIFEST = "manifest"
MANIFEST_SCHEMA = "run_id string, part string, format string, schema string, rows bigint, written_at string"


def write_run(
    spark: SparkSession, path: str, run_id: str, reports: dict[str, DataFrame], tables: dict[str, DataFrame] | None = None
) -> dict[str, int]:
    """``reports`` become JSON lines, ``tables`` Parquet. Returns the rows of each part."""
    folder, rows = f"{path.rstrip('/')}/{run_id}", []
    for kind, parts in (("json", reports), ("parquet", tables or {})):
        for name, part in parts.items():
            if name == MANIFEST:
                raise ValueError(f"a part must not be named {MANIFEST}")
            seen = Observation()
            counted = part.observe(seen, F.count(F.lit(1)).alias("rows"))
            if kind == "json":
                write_report(counted, f"{folder}/{name}")
            else:
                counted.write.mode("overwrite").parquet(f"{folder}/{name}")
            rows.append((run_id, name, kind, part.schema.json(), seen.get["rows"], None))
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA).withColumn("written_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    # One row per part, in one file: it appears at once.
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/{MANIFEST}")
    return {r[1]: r[4] for r in rows}


def complete_runs(spark: SparkSession, path: str) -> DataFrame:
    """The manifests of all complete runs below the folder; none if there is none."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(f"{path.rstrip('/')}/*/{MANIFEST}")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def read_part(spark: SparkSession, path: str, run_id: str, name: str) -> DataFrame:
    """One part of a complete run, with the types that it was written with."""
    found = complete_runs(spark, path).where((F.col("run_id") == run_id) & (F.col("part") == name)).first()
    if found is None:
        raise ValueError(f"run {run_id} has no complete part {name}")
    schema, folder = T.StructType.fromJson(json.loads(found["schema"])), f"{path.rstrip('/')}/{run_id}/{name}"
    part = read_report(spark, folder, schema) if found["format"] == "json" else spark.read.schema(schema).parquet(folder)
    if (rows := part.count()) != found["rows"]:
        raise ValueError(f"part {name} of run {run_id} has {rows} rows, its manifest says {found['rows']}")
    return part
