"""Exact quantiles by distributed selection.

``percentile`` keeps every distinct value of a group in one buffer.  Here a rank is
located instead: one pass takes each group's count and range.  A group of more than
``SMALL`` values is narrowed: a quantile sketch of bounded size gives two pivots around
the sought rank, and an exact count of the values below, at, between, at and above them
(partial aggregation, five rows per rank and task) says which part holds the rank; only
that part is narrowed again, to some 3 / ``GRID`` of its size whatever the distribution.
A part of at most ``SMALL`` values, or of one value, ends the search: its values are
sorted, and the two neighbours of the rank are interpolated linearly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surge.functions.columns import nan_to_null
from surge.plans.stage import materialize

#: Steps of the sketch that gives the pivots.
GRID = 128
#: Values of a part that are sorted in one buffer.
SMALL = 20_000


def _refined(values: DataFrame, sought: DataFrame, groups: list[str]) -> DataFrame:
    """Each sought rank with the one part of its range that holds it."""
    of = [*groups, "p"]
    v = F.col("_v")
    inside = values.join(sought, groups).where((v >= F.col("_lo")) & (v <= F.col("_hi")))
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    grid = inside.groupBy(*of).agg(F.percentile_approx("_v", steps, F.lit(GRID * 32)).alias("_grid"))
    step = F.floor((F.col("_k") - F.col("_before")) / F.col("_size") * GRID).cast("int")
    pivots = materialize(grid.join(sought, of).withColumns({
        "_a": F.get("_grid", F.greatest(step - 1, F.lit(0))), "_b": F.get("_grid", F.least(step + 2, F.lit(GRID)))})
        # the sketch rounds large longs: within the range every part is smaller than the whole
        .withColumns({c: F.greatest("_lo", F.least("_hi", c)) for c in ("_a", "_b")}).drop("_grid"))
    part = F.when(v < F.col("_a"), 0).when(v == F.col("_a"), 1).when(v < F.col("_b"), 2).when(v == F.col("_b"), 3).otherwise(4)
    inside = values.join(pivots, groups).where((v >= F.col("_lo")) & (v <= F.col("_hi")))
    parts = inside.groupBy(*of, part.alias("_part")).agg(F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    order = Window.partitionBy(*of).orderBy("_part")  # at most five rows for a rank
    parts = parts.withColumns({"_upto": F.sum("_m").over(order.rowsBetween(Window.unboundedPreceding, 0)), "_after": F.lead("_least").over(order)})
    j = parts.join(pivots, of).withColumn("_start", F.col("_before") + F.col("_upto") - F.col("_m"))
    hit = j.where((F.col("_start") <= F.col("_k")) & (F.col("_k") < F.col("_start") + F.col("_m")))
    return hit.select(*of, "_k", "_share", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), F.col("_start").alias("_before"),
                      F.col("_m").alias("_size"), F.coalesce("_after", "_nxt").alias("_nxt"))


def _located(values: DataFrame, sought: DataFrame, groups: list[str], small: int) -> DataFrame:
    """``sought`` with ``_low``, the value of rank ``_k`` (from 0) of its group, and ``_high``, the value of the next rank (or ``_low`` again).

    ``values`` (groups, _v) is a written table; ``sought`` has one row for each group and name ``p`` of a rank: (groups, p, _k, _share,
    _lo, _hi, _before, _size, _nxt), with the group's range and size."""
    sought = materialize(sought)
    wide = (F.col("_size") > small) & (F.col("_lo") < F.col("_hi"))
    while not (left := sought.where(wide)).isEmpty():
        sought = materialize(sought.where(~wide).unionByName(_refined(values, left, groups)))
    one = F.col("_lo") == F.col("_hi")
    within = values.join(sought.where(~one), groups).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
    lists = within.groupBy(*groups, "p").agg(F.sort_array(F.collect_list("_v")).alias("_list"))  # at most ``small`` values
    j = sought.join(lists, [*groups, "p"], "left")
    at = (F.col("_k") - F.col("_before")).cast("int")
    low = F.when(one, F.col("_lo")).otherwise(F.get("_list", at))
    last = F.col("_k") + 1 >= F.col("_before") + F.col("_size")
    high = F.when(last, F.coalesce("_nxt", low)).when(one, F.col("_lo")).otherwise(F.get("_list", at + 1))
    return j.withColumns({"_low": low, "_high": high})


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], *, keys: Sequence[str] = (),
                    small: int = SMALL) -> DataFrame:
    """(keys..., variable, p, value): linearly interpolated quantiles of each column per key.

    Missing values and NaN do not count; a missing key and a group without values have no row.  The narrow table (keys, variable, v) is
    written once (a stage boundary); every pass scans it, and work beyond the first pass is for the sought cells only.
    """
    keys, cols, groups = list(keys), list(cols), [*keys, "variable"]
    each = [F.struct(F.lit(c).alias("variable"), nan_to_null(F.col(f"`{c}`")).alias("_v")) for c in cols]
    values = df.select(*[F.col(f"`{k}`") for k in keys], F.explode(F.array(*each)).alias("_r")).select(*keys, "_r.*")
    values = materialize(values.dropna(subset=["_v", *keys]))
    span = values.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    rank = (F.col("_size") - 1) * F.col("p")
    sought = span.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).select(
        *groups, "p", F.floor(rank).cast("long").alias("_k"), (rank - F.floor(rank)).alias("_share"), "_lo", "_hi",
        F.lit(0).cast("long").alias("_before"), "_size", F.lit(None).cast("double").alias("_nxt"))
    j = _located(values, sought, groups, small)  # one row for each group, column and probability
    low, high = F.col("_low"), F.col("_high")
    return j.select(*groups, "p", F.when(F.col("_share") == 0, low).otherwise(low + (high - low) * F.col("_share")).alias("value"))


def rank_values(values: DataFrame, group: str, value: str, ranks: dict[str, Column], *, small: int = SMALL) -> DataFrame:
    """(group, p, rank, value): for each group and named rank (from 1, an expression of ``n``, the group's size) the value of that rank,
    NULL for rank 0.  Values are longs; missing groups and values do not count."""
    values = materialize(values.select(F.col(f"`{group}`").alias("_g"), F.col(f"`{value}`").cast("long").alias("_v")).dropna())
    span = values.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), r.cast("long").alias("rank")) for p, r in ranks.items()]))
    named = span.withColumn("_r", each).select("_g", "n", "_lo", "_hi", "_r.*")
    sought = named.where("rank > 0").select("_g", "p", (F.col("rank") - 1).alias("_k"), F.lit(0.0).alias("_share"), "_lo", "_hi",
                                            F.lit(0).cast("long").alias("_before"), F.col("n").alias("_size"), F.lit(None).cast("long").alias("_nxt"))
    found = _located(values, sought, ["_g"], small).select("_g", "p", (F.col("_k") + 1).alias("rank"), F.col("_low").alias("value"))
    none = named.where("rank = 0").select("_g", "p", "rank", F.lit(None).cast("long").alias("value"))
    return found.unionByName(none).withColumnRenamed("_g", group)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], *, keys: Sequence[str] = (), **kw) -> DataFrame:
    """(keys..., variable, q0, q1, ...): the quantiles of ``exact_quantiles`` side by side, in the order of ``probs``."""
    found = exact_quantiles(df, cols, probs, keys=keys, **kw)
    return found.groupBy(*keys, "variable").agg(*[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(f"q{i}") for i, p in enumerate(probs)])


def quantile_value(df: DataFrame, col: str, q: float) -> Column:
    """One column's quantile as a scalar subquery (NULL without values)."""
    return exact_quantiles(df, [col], [q]).select("value").scalar()
