"""Batch scoring of (request_id, date, key, capacity) requests against the panel.

The reference answers one request at a time; here a requests DataFrame is
validated, matched to history (nearest day per key, or exact day / month
mean), scored, banded and explained in one plan.  Matching never joins a
request with all history rows of its key: the nearest day is an as-of scan
(asked days and history interleaved per key, last / next history day carried by
the two-level fill), and the month means are per (key, month) aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surge.functions.columns import canonical_key
from surge.operators.ordered import fill

# Per-key baselines of the no-model fallback, its default, and band cut-offs.
FALLBACK_BASELINES = {"manhattan": 65, "brooklyn": 75, "queens": 70, "bronx": 85, "staten island": 45}
FALLBACK_DEFAULT = 60
FALLBACK_PROBABILITY = 0.45
HIGH_BAND, MODERATE_BAND = 0.7, 0.4
DEFAULT_CAPACITY = 80
HISTORY_MODERATE = 50   # no-model path: history above this is 'Moderate'
HISTORY_HIGH = 75       # failed-model path: history above this is 'High'
ALIGNED_WITHIN = 5      # interpretation: |prediction - history| within this is 'aligned'


def validate_requests(req: DataFrame, *, valid_keys: Iterable[str], key: str = "borough", date: str = "date",
                      fmt: str = "yyyy-MM-dd", capacity: str = "capacity") -> DataFrame:
    """Canonical key, parsed date, default capacity and a status / error per request."""
    k = canonical_key(key)
    d = F.try_to_timestamp(F.col(date).cast("string"), F.lit(fmt)).cast("date")
    err = (F.when(F.col(key).isNull() | F.col(date).isNull(), F.lit("missing field"))
            .when(~k.isin(*list(valid_keys)), F.lit("unknown key"))
            .when(d.isNull(), F.lit("bad date")))
    cap = F.coalesce(F.col(capacity), F.lit(DEFAULT_CAPACITY)) if capacity in req.columns else F.lit(DEFAULT_CAPACITY)
    return req.select("*").withColumns({
        key: k, "req_date": d, capacity: cap.cast("int"),
        "status": F.when(err.isNull(), "ok").otherwise("error"), "error": err})


def answer_all(validated: DataFrame, answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One record for each request of ``validate_requests``: ``answer`` turns the accepted ones into records; a rejected one
    gets ``success`` false, its ``error`` text, the request columns that the records have, and NULL elsewhere.

    ``answer`` must keep one row per request.  Both branches read the requests with their own filter; rejected requests
    never reach the history."""
    done = answer(validated.where(F.col("status") == "ok").drop("status", "error"))
    if "success" not in done.columns:
        done = done.withColumn("success", F.lit(True))
    done = done.withColumn("error", F.lit(None).cast("string"))
    carried = [c for c in validated.columns if c in done.columns and c not in ("success", "error", "status")]
    refused = validated.where(F.col("status") == "error").select(*carried, F.lit(False).alias("success"), "error")
    return done.unionByName(refused, allowMissingColumns=True)


def asked_days(req: DataFrame, *, key: str = "borough", req_date: str = "req_date") -> DataFrame:
    """The distinct (key, day) pairs of accepted requests.  What a model says depends on them alone, so each pair is scored
    once and joined to its requests: the models' work is bounded by keys x calendar days, however many requests there are."""
    return req.select(key, req_date).distinct()


def nearest_date_join(req: DataFrame, history: DataFrame, *, key: str = "borough", req_date: str = "req_date",
                      hist_date: str = "Date") -> DataFrame:
    """For each request, the history day of its key with the smallest absolute
    day distance (a tie goes to the earlier day): adds ``matched_date`` and
    ``day_gap``.  Requests whose key has no history get NULLs.

    Only the distinct (key, day) pairs asked for are matched (at most keys x
    calendar days, however many requests ask for one day).  They and the history
    days are interleaved per key in date order (history first on the same day);
    the last history day at or before an asked day and the next one after it are
    carried by a two-level scan.  Requests get the match of their (key, day), so
    repeated request ids keep their row count."""
    hd = history.select(F.col(key), F.col(hist_date).alias("_d")).distinct() \
                .select(key, "_d", F.lit(0).alias("_kind"), F.col("_d").alias("_h"))
    asked = req.where(F.col(req_date).isNotNull() & F.col(key).isNotNull()).select(
        key, F.col(req_date).alias("_d")).distinct().withColumns(
        {"_kind": F.lit(1), "_h": F.lit(None).cast("date")})
    u = hd.unionByName(asked)
    u = fill(u, ["_h"], keys=[key], order=["_d", "_kind"], direction="split")
    m = u.where(F.col("_kind") == 1)
    gp = F.datediff(F.col("_d"), F.col("_h_prev"))
    gn = F.datediff(F.col("_h_next"), F.col("_d"))
    pick = F.when(F.col("_h_next").isNull() | (F.col("_h_prev").isNotNull() & (gp <= gn)), F.col("_h_prev")) \
            .otherwise(F.col("_h_next"))
    m = m.select(F.col(key), F.col("_d").alias(req_date), pick.alias("matched_date"))
    out = req.join(m, on=[key, req_date], how="left").select(*req.columns, "matched_date")
    return out.withColumn("day_gap", F.abs(F.datediff(F.col(req_date), F.col("matched_date"))))


def historical_average(req: DataFrame, history: DataFrame, *, key: str = "borough", req_date: str = "req_date",
                       hist_date: str = "Date", measure: str = "Total_Hospitalization",
                       name: str = "historical_average") -> DataFrame:
    """Mean of ``measure`` over the key's history on the same month and day, else
    over the same month, else NULL; rounded half-even to 2 places.  One scan
    of the history into (key, month, day) sums and counts; the month level is
    rolled up from that small table (at most 366 rows per key)."""
    h = history.select(key, F.month(hist_date).alias("_m"), F.dayofmonth(hist_date).alias("_dd"), measure)
    days = h.groupBy(key, "_m", "_dd").agg(F.sum(measure).alias("_s"), F.count(measure).alias("_n"))
    md = days.select(key, "_m", "_dd", F.try_divide(F.col("_s"), F.col("_n")).alias("_md"))
    mo = days.groupBy(key, "_m").agg(F.try_divide(F.sum("_s"), F.sum("_n")).alias("_mo"))
    r = req.withColumns({"_m": F.month(req_date), "_dd": F.dayofmonth(req_date)})
    r = r.join(md, on=[key, "_m", "_dd"], how="left").join(mo, on=[key, "_m"], how="left")
    return r.withColumn(name, F.bround(F.coalesce("_md", "_mo"), 2)).drop("_m", "_dd", "_md", "_mo")


def cascade_features(req: DataFrame, history: DataFrame, features: Sequence[str], *, key: str = "borough",
                     req_date: str = "req_date", hist_date: str = "Date") -> DataFrame:
    """Feature vector per request: the key's row on the exact day, else the mean
    of the key's rows in that month, else 0; ``match_level`` says which."""
    feats = list(features)
    exact = history.select(key, F.col(hist_date).alias(req_date), F.lit(True).alias("_exact"),
                           *[F.col(f"`{c}`").alias(f"_e_{i}") for i, c in enumerate(feats)]) \
                   .dropDuplicates([key, req_date])
    month = history.groupBy(key, F.month(hist_date).alias("_m")).agg(
        F.lit(True).alias("_month"), *[F.avg(f"`{c}`").alias(f"_a_{i}") for i, c in enumerate(feats)])
    r = req.withColumn("_m", F.month(req_date)).join(exact, on=[key, req_date], how="left") \
           .join(month, on=[key, "_m"], how="left")
    out = r.withColumns({c: F.when(F.col("_exact"), F.col(f"_e_{i}"))
                              .when(F.col("_month"), F.col(f"_a_{i}")).otherwise(F.lit(0.0)).cast("double")
                         for i, c in enumerate(feats)})
    out = out.withColumn("match_level", F.when(F.col("_exact"), "exact").when(F.col("_month"), "month")
                         .otherwise("none"))
    return out.drop("_m", "_exact", "_month", *[f"_e_{i}" for i in range(len(feats))],
                    *[f"_a_{i}" for i in range(len(feats))])


def risk_band(prob: Column, *, high: float = HIGH_BAND, moderate: float = MODERATE_BAND) -> Column:
    return F.when(prob >= high, "High").when(prob >= moderate, "Moderate").otherwise("Low")


def binary_band(pred: Column) -> Column:
    return F.when(pred == 1, "High").otherwise("Low")


def score_capacity(df: DataFrame, *, predicted: str = "predicted_count", capacity: str = "capacity",
                   key_mean: str | None = None) -> DataFrame:
    """Additional beds = max(0, ceil(predicted - capacity)), utilisation %, status
    and (with ``key_mean``) the change against the key's historical mean."""
    beds = F.greatest(F.lit(0), F.ceil(F.col(predicted) - F.col(capacity)).cast("int"))
    out = df.withColumns({
        "additional_beds_needed": beds,
        "utilization_percent": F.try_divide(F.col(predicted), F.col(capacity).cast("double")) * 100,
        "capacity_status": F.when(beds > 0, "CAPACITY EXCEEDED").otherwise("WITHIN CAPACITY"),
    })
    if key_mean:
        out = out.withColumn("vs_key_mean_pct", (F.try_divide(F.col(predicted), F.col(key_mean)) - 1) * 100)
    return out


def _truthy(c: Column) -> Column:
    """A history value counts only when present and non-zero."""
    return c.isNotNull() & (c != 0)


def score_fallback(df: DataFrame, *, key: str = "borough", history: str = "historical_average",
                   baselines: dict[str, float] | None = None, default: float = FALLBACK_DEFAULT) -> DataFrame:
    """No-model answer: the history if present (Moderate above 50, else Low;
    probability min(h/100, 0.95)), else the key's constant baseline (Moderate, 0.45)."""
    baselines = FALLBACK_BASELINES if baselines is None else baselines
    base = F.lit(float(default))
    for k, v in baselines.items():
        base = F.when(F.col(key) == k, F.lit(float(v))).otherwise(base)
    h = F.col(history)
    has = _truthy(h)
    return df.withColumns({
        "success": F.lit(True),
        "expected_admissions": F.when(has, h).otherwise(base),
        "risk_level": F.when(has, F.when(h > HISTORY_MODERATE, "Moderate").otherwise("Low")).otherwise("Moderate"),
        "risk_probability": F.when(has, F.least(h / 100.0, F.lit(0.95))).otherwise(F.lit(FALLBACK_PROBABILITY)),
        "confidence": F.when(has, "Medium (Historical Data)").otherwise("Low (Baseline)"),
    })


def score_error_fallback(df: DataFrame, *, prediction: str = "expected_admissions",
                         history: str = "historical_average") -> DataFrame:
    """Rows whose model prediction is missing: history with >75 -> High else
    Moderate; without history the request is unsuccessful."""
    h = F.col(history)
    failed = F.col(prediction).isNull()
    has = _truthy(h)
    return df.withColumns({
        "success": F.when(~failed, F.lit(True)).otherwise(has),
        "expected_admissions": F.when(~failed, F.col(prediction)).when(has, h).otherwise(F.lit(0.0)),
        "risk_probability": F.when(~failed, F.col("risk_probability")).when(has, F.least(h / 100.0, F.lit(0.95)))
                             .otherwise(F.lit(0.0)),
        "risk_level": F.when(~failed, F.col("risk_level")).when(has, F.when(h > HISTORY_HIGH, "High")
                                                                   .otherwise("Moderate")).otherwise("Unknown"),
        "confidence": F.when(~failed, F.col("confidence")).when(has, "Medium (Historical)").otherwise("Low"),
    })


def score_interpretation(df: DataFrame, *, expected: str = "expected_admissions",
                         history: str = "historical_average", risk: str = "risk_level") -> DataFrame:
    """Rounded admissions, difference to history (higher / lower beyond 5, else
    aligned), percent difference (0 when history <= 0) and the advice line."""
    adm = F.floor(F.col(expected) + 0.5)
    h = F.col(history)
    diff = adm - h
    direction = F.when(h.isNull(), F.lit(None)).when(F.abs(diff) > ALIGNED_WITHIN,
                                                     F.when(diff > 0, "higher").otherwise("lower")).otherwise("aligned")
    lvl = F.lower(F.col(risk))
    advice = (F.when(lvl == "high", "prepare for increased patient volume")
               .when(lvl == "moderate", "standard operating procedures").otherwise("lower than average volume"))
    return df.withColumns({
        "rounded_admissions": adm.cast("long"),
        "diff_vs_history": diff,
        "abs_diff_rounded": F.floor(F.abs(diff) + 0.5).cast("long"),
        "direction": direction,
        "pct_vs_history": F.when(h.isNull(), F.lit(None)).when(h > 0, diff / h * 100).otherwise(F.lit(0.0)),
        "advice": advice,
    })


def response_record(df: DataFrame, *, key: str = "borough", req_date: str = "req_date") -> DataFrame:
    """Display fields of the response: title-cased key and 'Month dd, yyyy' date."""
    return df.withColumns({"display_key": F.initcap(F.col(key)),
                           "display_date": F.date_format(F.col(req_date), "MMMM dd, yyyy")})
