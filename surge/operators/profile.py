"""Profiling: missing counts, describe, value counts, data summary, correlations.

Each profile is one aggregate pass producing a single row (or one row per
group), reshaped to long form with ``explode(array(struct))`` - never a
per-column loop of jobs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surge.functions.columns import nan_to_null
from surge.plans.stage import materialize

def _long(one: DataFrame, rows: list[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing, n_rows) for every column, from one aggregate."""
    cols = list(cols) if cols is not None else df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    return _long(one, [F.struct(F.lit(c).alias("column"), (F.col("_n") - F.col(f"c{i}")).alias("n_missing"),
                                F.col("_n").alias("n_rows")) for i, c in enumerate(cols)])


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear), max per column, long form."""
    from surge.operators.quantile import quantile_table
    df = materialize(df.select(*[F.col(f"`{c}`") for c in cols]))  # read by the sums and by the selection
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    sums = _long(one, [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                                F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                                F.col(f"hi{i}").alias("max"))
                       for i, c in enumerate(cols)])
    q = quantile_table(df, cols, [0.25, 0.5, 0.75]).select(F.col("variable").alias("column"), F.col("q0").alias("p25"),
                                                           F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return sums.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def data_summary(df: DataFrame, *, key: str = "borough", date: str = "Date",
                 measures: Sequence[str] = ("Total_Hospitalization", "Asthma_Count", "Respiratory_Count")) -> DataFrame:
    """One row: rows, first/last date, distinct days, sorted years, number and
    sorted list of keys, sum of each measure.  The collected sets are bounded by
    the calendar and the key domain."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.countDistinct(date).alias("n_days"),
        F.array_join(F.sort_array(F.collect_set(F.year(date).cast("string"))), ",").alias("years"),
        F.countDistinct(key).alias("n_keys"),
        F.array_join(F.sort_array(F.collect_set(key)), ",").alias("keys"),
        *[F.sum(m).alias(f"sum_{m}") for m in measures if m in df.columns])


_MOMENTS = "a int, b int, n long, ma double, mb double, va double, vb double, c double"


def co_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, n, ma, mb, va, vb, c): one small row per task and pair of columns (positions a <= b), over rows that have both.

    ``ma``, ``mb`` are means, ``va``, ``vb``, ``c`` centred sums of squares and products.  A task multiplies its batches' value and
    presence matrices, shifted by the first value seen in each column, so a row is read once whatever the number of pairs."""
    d = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.full(d, np.nan)
        n, sums, squares, products = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(d)], axis=1) if batch.num_rows else np.zeros((0, d))
            have = ~np.isnan(x)
            new = np.isnan(pivot) & have.any(0)
            pivot[new] = x[have.argmax(0)[new], new]
            y = np.where(have, x - pivot, 0.0)
            m = have.astype(float)
            n += m.T @ m
            sums += y.T @ m          # of a, where b is present
            squares += (y * y).T @ m
            products += y.T @ y
        a, b = np.nonzero(np.triu(n > 0))
        k = n[a, b]
        sa, sb = sums[a, b], sums[b, a]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(k.astype(np.int64)), pa.array(pivot[a] + sa / k), pa.array(pivot[b] + sb / k),
             pa.array(squares[a, b] - sa * sa / k), pa.array(squares[b, a] - sb * sb / k), pa.array(products[a, b] - sa * sb / k)],
            names=["a", "b", "n", "ma", "mb", "va", "vb", "c"])

    return df.select(*[nan_to_null(F.col(f"`{c}`")).alias(f"x{i}") for i, c in enumerate(cols)]).mapInArrow(run, _MOMENTS)


def _pair_corr(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(var1, var2, corr) for the given pairs: Pearson r over the rows that have both values; NULL when there are none, or a
    side is constant on them.

    The co-moments of all tasks are merged around the least mean of a pair's parts, so a constant side has variance 0 exactly."""
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(cols)}
    parts = materialize(co_moments(df, cols))  # a few numbers per task and pair
    low = parts.groupBy("a", "b").agg(F.min("ma").alias("ra"), F.min("mb").alias("rb"))
    n, x, y = F.col("n"), F.col("ma") - F.col("ra"), F.col("mb") - F.col("rb")
    got = parts.join(low, ["a", "b"]).groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.sum(n * x).alias("sx"), F.sum(n * y).alias("sy"), F.sum(F.col("va") + n * x * x).alias("xx"),
        F.sum(F.col("vb") + n * y * y).alias("yy"), F.sum(F.col("c") + n * x * y).alias("xy"))
    va, vb = F.col("xx") - F.col("sx") * F.col("sx") / n, F.col("yy") - F.col("sy") * F.col("sy") / n
    got = got.select("a", "b", F.when((va > 0) & (vb > 0), F.try_divide(F.col("xy") - F.col("sx") * F.col("sy") / n, F.sqrt(va) * F.sqrt(vb))).alias("corr"))
    wanted = df.sparkSession.createDataFrame([(p, q, min(at[p], at[q]), max(at[p], at[q])) for p, q in pairs], "var1 string, var2 string, a int, b int")
    return wanted.join(got, on=["a", "b"], how="left").select("var1", "var2", "corr")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlation of every pair (var1, var2, corr).  Only the
    upper triangle is computed; the mirror rows are a projection of it."""
    cols = list(cols)
    upper = _pair_corr(df, [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i, len(cols))])
    lower = upper.where(F.col("var1") != F.col("var2")).select(
        F.col("var2").alias("var1"), F.col("var1").alias("var2"), "corr")
    return upper.unionByName(lower)


def corr_with_target(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """(variable, corr) of every column with the target, pairwise-complete."""
    return _pair_corr(df, [(c, target) for c in cols]).select(F.col("var1").alias("variable"), "corr")


def corr_target_top(df: DataFrame, target: str, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Top-k correlations with the target (descending, missing last; the limit is the report)."""
    c = corr_with_target(df, target, cols)
    return c.orderBy(F.desc_nulls_last("corr"), F.asc("variable")).limit(k)


def corr_listwise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation matrix over rows complete in *all* listed columns."""
    return corr_matrix(df.dropna(how="any", subset=list(cols)), cols)


def corr_target_filtered(df: DataFrame, target: str, cols: Sequence[str],
                         contains: Sequence[str] = ("Temp", "Humidity", "Wind", "AirPres")) -> DataFrame:
    """Listwise correlation with the target, kept for columns whose name contains a marker."""
    complete = df.dropna(how="any", subset=[target, *cols])
    keep = [c for c in cols if any(m in c for m in contains)]
    return corr_with_target(complete, target, keep)


def service_stats(df: DataFrame, *, key: str = "borough", date: str = "Date",
                  measure: str = "Total_Hospitalization") -> DataFrame:
    """Records, mean daily admissions, key list and date span of the scoring history."""
    return df.agg(F.count(F.lit(1)).alias("total_records"), F.avg(measure).alias("avg_daily_admissions"),
                  F.array_join(F.sort_array(F.collect_set(key)), ",").alias("keys"),
                  F.min(date).alias("first_date"), F.max(date).alias("last_date"))
