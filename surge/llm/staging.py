"""Tables written to the shared folder that the session names (``spark.checkpoint.dir``)."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from surge.session import ensure_checkpoint_dir

#: Spark's setting by which a write's shuffle files go with the write (from 4.1; other versions ignore it).
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: At most once in so many seconds.
SETTLE_SECONDS = 4.0
_settled = 0.0


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (``options`` of the writer) in the shared folder and read it back: lineage ends here, lost executors cost nothing."""
    path = shared_path(df.sparkSession, name)
    with setting(df.sparkSession, DROP_SHUFFLES, "true"):  # they need not wait for a collector to find the write's plan
        df.write.options(**options).parquet(path)
    _settle(df.sparkSession)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._staged_path = path
    return back


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Within, a setting of the session has another value."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _settle(spark: SparkSession) -> None:
    """Let the JVM find the plans that are done with, so that Spark removes their shuffle files: on a long job they fill the disks
    long before the collector runs by itself."""
    global _settled
    if time.monotonic() - _settled > SETTLE_SECONDS:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _settled = time.monotonic()


def release(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` wrote, once nothing reads them any more."""
    for table in tables:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table._staged_path)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _settle(table.sparkSession)
