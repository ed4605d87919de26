import time

from pyspark.sql import functions as F

from surge.llm import staging


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_staged_write_leaves_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(staging, "_settle", lambda spark: None)  # whatever the collector does
    before = shuffle_files(spark)
    counts = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).count()
    both = spark.range(1000).withColumnRenamed("id", "k").hint("merge").join(counts, "k")
    back = staging.staged(both, "shuffles")
    deadline = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert back.agg(F.sum("count")).first()[0] == 20_000
    assert both.count() == 1000  # its rows can be made again
    assert spark.conf.get(staging.DROP_SHUFFLES, "false") == "false"
