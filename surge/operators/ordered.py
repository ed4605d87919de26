"""Ordered (scan) operators that never put a whole key - or the whole frame - into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; with
five keys one of them may hold a third of all rows.  The operators here use a
two-level scan instead:

1. rows are windowed inside small *buckets* (key x month by default), which
   spreads a hot key over many tasks;
2. a per-bucket summary (one row per bucket: row count, last / first non-null
   value) is scanned in bucket order - it is tiny compared to the rows;
3. the carry of every bucket is joined back and combined with the local result.

Row lags and rolling frames use plain windows inside the buckets and a halo: the last rows before a bucket and the
first rows after it, gathered from the bucket summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from surge.plans.stage import materialize

UNB_PREC = Window.unboundedPreceding
UNB_FOLL = Window.unboundedFollowing


def month_bucket(date: str = "Date") -> list[Column]:
    return [F.trunc(F.col(date), "MM").alias("_bk0")]


def _bucketed(df: DataFrame, buckets: Sequence[Column] | None, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    buckets = list(buckets) if buckets is not None else month_bucket(order[0])
    names = [f"_bk{i}" for i in range(len(buckets))]
    return df.select("*", *[b.alias(n) for b, n in zip(buckets, names)]), names


def row_index(df: DataFrame, *, keys: Sequence[str] = (), order: Sequence[str] = ("Date",),
              buckets: Sequence[Column] | None = None, name: str = "_rn") -> DataFrame:
    """1-based row number per ``keys`` in ``order`` (ties must be broken by ``order``).

    ``buckets`` must be monotone in ``order`` within a key (default: month of the
    first order column, which must then be a date).  With no ``keys`` this is a frame-wide row number.
    """
    keys, order = list(keys), list(order)
    b, bk = _bucketed(df, buckets, order)
    local = b.withColumn("_lrn", F.row_number().over(Window.partitionBy(*keys, *bk).orderBy(*order)))
    counts = b.groupBy(*keys, *bk).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*bk).rowsBetween(UNB_PREC, -1)
    offs = counts.select(*keys, *bk, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(offs, on=[*keys, *bk])
                 .withColumn(name, (F.col("_lrn") + F.col("_off")).cast("long"))
                 .drop("_lrn", "_off", *bk))


def fill(df: DataFrame, cols: Sequence[str], *, keys: Sequence[str] = (), order: Sequence[str] = ("Date",),
         buckets: Sequence[Column] | None = None, direction: str = "forward",
         suffix: str = "") -> DataFrame:
    """Fill of ``cols`` per ``keys`` in ``order``: ``forward`` (last non-null so
    far), ``backward`` (next non-null) or ``both`` (forward, then backward for
    the leading gap).  Result columns are ``c + suffix`` (replacing ``c`` when
    suffix is empty).  ``split`` returns both directions separately as
    ``c + "_prev"`` and ``c + "_next"``.  Works for any column type, structs included.

    Both directions share one local window sort and one bucket summary."""
    keys, order, cols = list(keys), list(order), list(cols)
    if not cols:
        return df
    dirs = ["forward", "backward"] if direction in ("both", "split") else [direction]
    b, bk = _bucketed(df, buckets, order)
    wl = {"forward": Window.partitionBy(*keys, *bk).orderBy(*order).rowsBetween(UNB_PREC, 0),
          "backward": Window.partitionBy(*keys, *bk).orderBy(*order).rowsBetween(0, UNB_FOLL)}
    wc = {"forward": Window.partitionBy(*keys).orderBy(*bk).rowsBetween(UNB_PREC, -1),
          "backward": Window.partitionBy(*keys).orderBy(*bk).rowsBetween(1, UNB_FOLL)}
    local_fn = {"forward": F.last, "backward": F.first}
    pick = {"forward": F.max_by, "backward": F.min_by}
    # a single ordering column keeps the max_by / min_by buffers fixed-width (hash aggregate)
    ordk = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(o) for o in order])
    local = b.select("*", *[local_fn[d](F.col(c), ignorenulls=True).over(wl[d]).alias(f"_loc_{d[0]}{i}")
                            for d in dirs for i, c in enumerate(cols)])
    summ = b.groupBy(*keys, *bk).agg(*[pick[d](F.col(c), F.when(F.col(c).isNotNull(), ordk)).alias(f"_edge_{d[0]}{i}")
                                       for d in dirs for i, c in enumerate(cols)])
    carry = summ.select(*keys, *bk, *[local_fn[d](F.col(f"_edge_{d[0]}{i}"), ignorenulls=True).over(wc[d])
                                      .alias(f"_carry_{d[0]}{i}") for d in dirs for i in range(len(cols))])
    out = local.join(carry, on=[*keys, *bk])
    filled = {}
    for i, c in enumerate(cols):
        if direction == "split":
            filled[c + "_prev"] = F.coalesce(F.col(f"_loc_f{i}"), F.col(f"_carry_f{i}"))
            filled[c + "_next"] = F.coalesce(F.col(f"_loc_b{i}"), F.col(f"_carry_b{i}"))
            continue
        parts = []
        for d in dirs:
            parts += [F.col(f"_loc_{d[0]}{i}"), F.col(f"_carry_{d[0]}{i}")]
        filled[c + suffix] = F.coalesce(*parts)
    out = out.withColumns(filled)
    tmp = [f"_{kind}_{d[0]}{i}" for kind in ("loc", "carry") for d in dirs for i in range(len(cols))]
    return out.drop(*tmp, *bk)


def _with_halo(df: DataFrame, cols: Sequence[str], before: int, after: int, local: dict[str, Callable[[WindowSpec], Column]], *,
               keys: Sequence[str], order: Sequence[str], buckets: Sequence[Column] | None) -> tuple[DataFrame, list[str]]:
    """Rows with ``_at`` (1-based place in their bucket), ``_size`` (rows of the bucket), ``_rn`` (row number within keys), the ``local``
    columns, and the halo of their bucket: ``_prev`` and ``_next``, arrays of the values of ``cols`` in the ``before`` rows that precede it
    and the ``after`` rows that follow it.  Also returns the names of the helper columns.

    One shuffle by (keys, bucket) sorts the rows; the result is a stage boundary, from which one small row per bucket (its first and
    last rows) is taken and scanned in bucket order.  The input is read once, no row is sent twice, and parallelism is the
    number of buckets of all keys."""
    keys, order = list(keys), list(order)
    b, bk = _bucketed(df, buckets, order)
    inside = Window.partitionBy(*keys, *bk)
    rows = b.select("*", F.row_number().over(inside.orderBy(*order)).alias("_at"), F.count(F.lit(1)).over(inside).alias("_size"),
                    *[f(inside.orderBy(*order)).alias(n) for n, f in local.items()])
    rows = materialize(rows)
    values = F.struct(F.col("_at").alias("at"), *[F.col(f"`{c}`").alias(c) for c in cols])
    last, first = F.col("_at") > F.col("_size") - before, F.col("_at") <= after
    edges = rows.where(last | first | (F.col("_at") == 1)).groupBy(*keys, *bk, "_size").agg(
        F.sort_array(F.collect_list(F.when(last, values))).alias("_tail"), F.sort_array(F.collect_list(F.when(first, values))).alias("_head"))
    seq = Window.partitionBy(*keys).orderBy(*bk)
    prev = F.flatten(F.collect_list("_tail").over(seq.rowsBetween(-max(before, 1), -1)))
    nxt = F.flatten(F.collect_list("_head").over(seq.rowsBetween(1, max(after, 1))))
    edges = edges.select(*keys, *bk, F.coalesce(F.sum("_size").over(seq.rowsBetween(UNB_PREC, -1)), F.lit(0)).alias("_off"),
                         F.slice(prev, F.greatest(F.size(prev) - before + 1, F.lit(1)), before).alias("_prev"), F.slice(nxt, 1, after).alias("_next"))
    out = rows.join(edges, on=[*keys, *bk]).withColumn("_rn", (F.col("_at") + F.col("_off")).cast("long"))
    return out, ["_at", "_size", "_off", "_prev", "_next", "_rn", *bk, *local]


def lag_rows(df: DataFrame, cols: Sequence[str], lags: Sequence[int], *, keys: Sequence[str] = (),
             order: Sequence[str] = ("Date",), buckets: Sequence[Column] | None = None,
             name: str = "{col}_lag{k}") -> DataFrame:
    """Value ``k`` rows earlier per ``keys`` in ``order`` for each col and lag.

    Rows of a bucket are lagged by a plain window; the first rows of a bucket take their
    values from its halo, the last rows before it."""
    keys, cols, lags = list(keys), list(cols), list(lags)
    local = {f"_l{k}_{i}": (lambda w, c=c, k=k: F.lag(F.col(f"`{c}`"), k).over(w)) for k in lags for i, c in enumerate(cols)}
    rows, _ = _with_halo(df, cols, max(lags, default=0), 0, local, keys=keys, order=order, buckets=buckets)

    def lagged(i: int, c: str, k: int) -> Column:
        held = F.get("_prev", F.size("_prev") + F.col("_at") - 1 - k)
        return F.when(F.col("_at") > k, F.col(f"_l{k}_{i}")).otherwise(held.getField(c)).alias(name.format(col=c, k=k))

    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[lagged(i, c, k) for k in lags for i, c in enumerate(cols)])


def _present(rows: Column, c: str) -> Column:
    """The non-missing values of a field in an array of rows; none for a NULL array."""
    values = F.filter(F.transform(rows, lambda x: x.getField(c).cast("double")), lambda v: v.isNotNull())
    return F.coalesce(values, F.array().cast("array<double>"))


def rolling_mean_rows(df: DataFrame, cols: Sequence[str], *, window: int = 7, shift: int = 0,
                      keys: Sequence[str] = (), order: Sequence[str] = ("Date",),
                      buckets: Sequence[Column] | None = None, name: str = "{col}_roll{w}",
                      count_name: str | None = None) -> DataFrame:
    """Mean of the non-missing values in the ``window`` rows ending ``shift`` rows
    before each row (min one value), per ``keys``.  A negative ``shift`` centres
    the window (``shift=-3, window=7``: three rows either side).

    A plain window sums the rows of the same bucket; the part of the frame that lies outside is summed from the bucket's
    halo.  ``count_name`` adds the number of values averaged, ``_rn`` the row number."""
    keys, cols = list(keys), list(cols)
    low, high = -shift - window + 1, -shift
    local = {}
    for i, c in enumerate(cols):
        local[f"_s{i}"] = lambda w, c=c: F.sum(F.col(f"`{c}`").cast("double")).over(w.rowsBetween(low, high))
        local[f"_c{i}"] = lambda w, c=c: F.count(F.col(f"`{c}`")).over(w.rowsBetween(low, high))
    before, after = max(-low, 0), max(high, 0)
    rows, _ = _with_halo(df, cols, before, after, local, keys=keys, order=order, buckets=buckets)
    # The frame covers the places _at + low .. _at + high; of _prev those below 1, of _next those above _size.
    held = F.size("_prev")
    from_prev = F.greatest(held + F.col("_at") + low, F.lit(1))
    n_prev = F.greatest(F.least(held, held + F.col("_at") + high) - from_prev + 1, F.lit(0))
    from_next = F.greatest(F.col("_at") + low - F.col("_size"), F.lit(1)).cast("int")
    n_next = F.greatest(F.col("_at") + high - F.col("_size") - from_next + 1, F.lit(0)).cast("int")
    outside = []
    if before:
        outside.append(F.when(n_prev > 0, F.slice("_prev", from_prev, n_prev)))
    if after:
        outside.append(F.when(n_next > 0, F.slice("_next", from_next, n_next)))
    rows = rows.withColumns({f"_o{j}": x for j, x in enumerate(outside)})
    means, counts = [], []
    for i, c in enumerate(cols):
        total, count = F.coalesce(F.col(f"_s{i}"), F.lit(0.0)), F.col(f"_c{i}")
        for j in range(len(outside)):
            values = _present(F.col(f"_o{j}"), c)
            total = total + F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
            count = count + F.size(values)
        means.append(F.try_divide(total, count.cast("double")).alias(name.format(col=c, w=window)))
        if count_name:
            counts.append(count.cast("long").alias(count_name.format(col=c)))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *means, *counts, "_rn")
