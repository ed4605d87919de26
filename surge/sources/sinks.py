"""Sinks: panel, results, decomposition components and the model artifact bundle.

Tables are written partitioned by key where readers filter by key; the
artifact bundle is Spark ML's own format (scaler, assembler and model as one fitted
pipeline) plus a JSON manifest next to a parquet copy of the scoring history; its
versions are published by writing the manifest last.
"""

from __future__ import annotations

import json
import re

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surge.session import file_system


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: str | None = None,
                mode: str = "overwrite") -> None:
    """Weather collection, merged panel, result tables, decomposition components."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, *, fmt: str = "parquet", schema=None) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.load(path)


def save_bundle(path: str, *, models: dict, features: list[str], history: DataFrame,
                extra: dict | None = None) -> None:
    """Models (each saved with its own writer), manifest and scoring history."""
    names = {}
    for name, m in models.items():
        sub = name.replace(" ", "_")
        m.write().overwrite().save(f"{path}/models/{sub}")
        names[name] = {"path": f"models/{sub}", "class": f"{type(m).__module__}.{type(m).__name__}"}
    history.write.mode("overwrite").parquet(f"{path}/history")
    manifest = {"models": names, "features": list(features), **(extra or {})}
    spark = history.sparkSession
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1) \
         .write.mode("overwrite").text(f"{path}/manifest")


def load_bundle(spark: SparkSession, path: str) -> tuple[dict, list[str], DataFrame, dict]:
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    models = {}
    for name, meta in manifest["models"].items():
        mod, cls = meta["class"].rsplit(".", 1)
        klass = getattr(__import__(mod, fromlist=[cls]), cls)
        reader = klass if issubclass(klass, MLReadable) else PipelineModel
        models[name] = reader.load(f"{path}/{meta['path']}")
    return models, manifest["features"], spark.read.parquet(f"{path}/history"), manifest


# ---------------------------------------------------------------- versions of a bundle

def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete bundles below ``root``: those whose manifest is written (it is written last)."""
    fs, place = file_system(spark, root)
    if not fs.exists(place):
        return []
    found = []
    for s in fs.listStatus(place):
        name = s.getPath().getName()
        if re.fullmatch(r"v\d+", name) and fs.exists(file_system(spark, f"{root}/{name}/manifest/_SUCCESS")[1]):
            found.append(int(name[1:]))
    return sorted(found)


def publish_bundle(root: str, *, models: dict, features: list[str], history: DataFrame, extra: dict | None = None) -> int:
    """Write the next version of a bundle below ``root``; readers see it once its manifest is there.  Returns its number."""
    spark = history.sparkSession
    number = max(_versions(spark, root), default=0) + 1
    save_bundle(f"{root}/v{number}", models=models, features=features, history=history, extra={**(extra or {}), "version": number})
    return number


def latest_bundle(spark: SparkSession, root: str) -> tuple[dict, list[str], DataFrame, dict] | None:
    """The newest complete version, as ``load_bundle`` gives it; None when there is none."""
    found = _versions(spark, root)
    return load_bundle(spark, f"{root}/v{found[-1]}") if found else None


# ---------------------------------------------------------------- result tables

def write_partitions(df: DataFrame, path: str, *, partition_by: str, run: str) -> None:
    """Replace the partitions that ``df`` has and keep all others; a manifest entry for ``run`` is committed last.

    A reader (``read_committed``) sees rows of committed runs only, so a job that dies halfway leaves no partial result behind:
    every run writes files below its own folder of a partition, and the manifest says which run holds which partition."""
    spark = df.sparkSession
    df.withColumn("_run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_by, "_run").parquet(f"{path}/rows")
    held = df.select(F.col(partition_by).cast("string").alias("part")).distinct()
    entries = held.select("part", F.lit(run).alias("run"), F.lit(len(_manifest_runs(spark, path))).alias("turn"))
    entries.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{run}")


def _manifest_runs(spark: SparkSession, path: str) -> list[str]:
    fs, place = file_system(spark, f"{path}/manifest")
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return [n for n in names if fs.exists(file_system(spark, f"{path}/manifest/{n}/_SUCCESS")[1])]


def read_committed(spark: SparkSession, path: str, *, partition_by: str) -> DataFrame:
    """The rows of each partition from the last committed run that wrote it."""
    runs = _manifest_runs(spark, path)
    if not runs:
        raise FileNotFoundError(f"no committed run in {path}")
    entries = spark.read.parquet(*[f"{path}/manifest/{r}" for r in runs])
    last = entries.groupBy("part").agg(F.max_by("run", "turn").alias("_last"))  # one row per partition
    rows = spark.read.parquet(f"{path}/rows").withColumn("_part", F.col(partition_by).cast("string"))
    return rows.join(last, (F.col("_part").eqNullSafe(F.col("part"))) & (F.col("_run") == F.col("_last"))).drop("_part", "part", "_run", "_last")
