"""Online scoring re-aimed as Structured Streaming.

The reference answers single HTTP requests; here request records landing as
files in a folder are scored in micro-batches.  Each batch runs the same batch
operators (validation, historical average, no-model fallback, interpretation)
against a history table and answers every request, rejected ones with their
error.  The sink commits a batch once: a replayed batch (a restart between the
write and the offset commit) finds its marker and leaves the first answer as it is.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surge.operators import scoring as sc
from surge.session import file_system

REQUEST_SCHEMA = "request_id long, borough string, date string, capacity int"


def score_batch(batch: DataFrame, history: DataFrame, *, valid_keys: Iterable[str]) -> DataFrame:
    """One record per request of the batch: answered, or ``success`` false with the error text."""
    return sc.answer_all(sc.validate_requests(batch, valid_keys=valid_keys), lambda ok: sc.response_record(
        sc.score_interpretation(sc.score_fallback(sc.historical_average(ok, history)))))


def committed(spark: SparkSession, out_dir: str, batch_id: int) -> bool:
    fs, marker = file_system(spark, f"{out_dir}/_committed/{batch_id}")
    return fs.exists(marker)


def commit_batch(rows: DataFrame, out_dir: str, batch_id: int) -> bool:
    """Write a batch's rows and then its marker; False when the batch is committed already (nothing is written).

    Rows of an attempt that died before its marker are overwritten by the next one."""
    spark = rows.sparkSession
    if committed(spark, out_dir, batch_id):
        return False
    rows.write.mode("overwrite").parquet(f"{out_dir}/batches/batch={batch_id}")
    fs, marker = file_system(spark, f"{out_dir}/_committed/{batch_id}")
    fs.create(marker, True).close()
    return True


def read_answers(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows of committed batches, with the batch id as column ``batch``."""
    fs, place = file_system(spark, f"{out_dir}/_committed")
    done = [int(s.getPath().getName()) for s in fs.listStatus(place)]
    return spark.read.option("basePath", f"{out_dir}/batches").parquet(f"{out_dir}/batches").where(F.col("batch").isin(done))


def start_request_stream(spark: SparkSession, requests_dir: str, history: DataFrame, out_dir: str,
                         checkpoint_dir: str, *, valid_keys: Iterable[str], fmt: str = "json"):
    """Start the streaming scorer; returns the StreamingQuery."""
    keys = list(valid_keys)
    stream = spark.readStream.schema(REQUEST_SCHEMA).format(fmt).load(requests_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not committed(batch.sparkSession, out_dir, batch_id):
            commit_batch(score_batch(batch, history, valid_keys=keys), out_dir, batch_id)

    return (stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
