"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code, straight from the mapping in
FIXTURES.md section 4: the reference-shaped feeds are CTEs over the driver
tables.  Doubles are rounded to 6 places on both sides (sum order differs).
"""

from __future__ import annotations

PLACES = "('automobile','building','furniture','household','machinery')"
KEEP_YEARS = "(1995,1996,1997,1998,2000,2001)"


def rnd(expr: str) -> str:
    """Half-up rounding of the shortest decimal form to 6 places (what Spark's
    ``round`` does); plain ``round`` for values beyond DECIMAL range."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"coalesce(CAST(CAST(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)) AS DECIMAL(38,6)) AS DOUBLE), "
            f"round({x}, 6))")


def r6(expr: str, alias: str) -> str:
    return f"{rnd(expr)} AS {alias}"


# ---------------------------------------------------------------- feeds

OV = """ov AS (
  SELECT CAST(o.o_orderdate AS DATE) AS dt, lower(trim(c.c_mktsegment)) AS place,
         o.o_orderpriority IN ('1-URGENT','2-HIGH') AS is_resp,
         CAST(floor(o.o_totalprice / 10000) AS DOUBLE) AS cnt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

HEALTH = OV + f""",
resp AS (SELECT dt, place, sum(cnt) AS rc FROM ov WHERE is_resp GROUP BY dt, place),
asth AS (SELECT dt, place, sum(cnt) AS ac FROM ov WHERE NOT is_resp GROUP BY dt, place),
health AS (
  SELECT coalesce(r.dt, a.dt) AS Date, coalesce(r.place, a.place) AS borough,
         coalesce(r.rc, 0) AS Respiratory_Count, coalesce(a.ac, 0) AS Asthma_Count,
         coalesce(r.rc, 0) + coalesce(a.ac, 0) AS Total_Hospitalization,
         CAST(year(coalesce(r.dt, a.dt)) AS INTEGER) AS year
  FROM resp r FULL JOIN asth a ON r.dt = a.dt AND r.place = a.place
  WHERE year(coalesce(r.dt, a.dt)) IN {KEEP_YEARS})"""

LW = """lw AS (
  SELECT CAST(l.l_shipdate AS DATE) AS dt, lower(trim(c.c_mktsegment)) AS place,
         l.l_quantity, l.l_linenumber, l.l_discount, l.l_extendedprice, l.l_returnflag, l.l_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""

WEATHER = LW + """,
weather AS (
  SELECT dt AS Date, place AS borough,
         avg(l_quantity) AS Temp_Max_C, avg(l_quantity - 20) AS Temp_Min_C,
         avg(CAST(30 + 10 * l_linenumber AS DOUBLE)) AS Humidity_Avg, avg(l_discount * 100) AS WindSpeed_mps
  FROM lw GROUP BY dt, place)"""

def airq_mean(cond: str) -> str:
    """Mean of five-decimal readings: whole units summed, one division."""
    return (f"sum(CAST(round(l_extendedprice / 1000 * 100000.0) AS BIGINT)) FILTER (WHERE {cond})::DOUBLE "
            f"/ nullif(count(*) FILTER (WHERE {cond}) * 100000.0::DOUBLE, 0)")


AIRQ = f"""airq AS (
  SELECT dt AS Date, place AS borough,
         {airq_mean("coalesce(l_returnflag, '') NOT IN ('A', 'N')")} AS AQ_Nitrogen_dioxide_NO2,
         {airq_mean("l_returnflag = 'N'")} AS AQ_Ozone_O3,
         {airq_mean("l_returnflag = 'A'")} AS AQ_Visits_due_to_PM25
  FROM lw GROUP BY dt, place)"""

PANEL = HEALTH + ",\n" + WEATHER + ",\n" + AIRQ + f""",
panel AS (
  SELECT h.*, w.Temp_Max_C, w.Temp_Min_C, w.Humidity_Avg, w.WindSpeed_mps,
         q.AQ_Nitrogen_dioxide_NO2, q.AQ_Ozone_O3, q.AQ_Visits_due_to_PM25
  FROM health h
  LEFT JOIN weather w ON h.Date = w.Date AND h.borough = w.borough
  LEFT JOIN airq q ON h.Date = q.Date AND h.borough = q.borough
  WHERE h.borough IN {PLACES})"""

PANEL_COLS = ["Respiratory_Count", "Asthma_Count", "Total_Hospitalization", "Temp_Max_C", "Temp_Min_C",
              "Humidity_Avg", "WindSpeed_mps", "AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3", "AQ_Visits_due_to_PM25"]


def coerce(x: str) -> str:
    return (f"CASE WHEN regexp_matches(trim({x}), '(?i)[0-9.][df]$') THEN NULL "
            f"ELSE TRY_CAST(trim({x}) AS DOUBLE) END")


def sel_round(cols, src_alias="") -> str:
    p = f"{src_alias}." if src_alias else ""
    return ", ".join(r6(p + c, c) for c in cols)


SQL: dict[str, str] = {}

SQL["src_visits"] = f"""WITH {OV}
SELECT dt AS Date, place AS borough, {r6('cnt', 'Count')},
       CASE WHEN is_resp THEN 'respiratory' ELSE 'asthma' END AS kind FROM ov"""

SQL["src_weather_daily"] = f"""WITH {LW}
SELECT dt AS Date, place AS borough, {r6('l_quantity', 'TMAX')}, {r6('l_quantity - 20', 'TMIN')},
       {r6('30 + 10 * l_linenumber', 'RHAV')}, {r6('l_discount * 100', 'AWND')},
       CAST(year(dt) AS INTEGER) AS year FROM lw"""

SQL["src_airq_long"] = f"""WITH {LW}
SELECT dt AS Date, place AS borough,
       CASE WHEN l_returnflag = 'A' THEN 'Visits due to PM2.5' WHEN l_returnflag = 'N' THEN 'Ozone (O3)'
            ELSE 'Nitrogen dioxide (NO2)' END AS Name,
       {r6('l_extendedprice / 1000', 'value')} FROM lw"""

SQL["feed_rejects"] = f"""WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey), {LW},
issues AS (
  SELECT 'visits' AS feed, CASE WHEN o_orderstatus = 'P' THEN 'bad date' WHEN c_nationkey = 0 THEN 'no key' END AS issue FROM o
  UNION ALL
  SELECT 'air_quality', CASE WHEN coalesce(l_returnflag, '') NOT IN ('A', 'N') THEN 'no date'
                             WHEN l_extendedprice / 1000 > 50 THEN 'rescued Data Value' END FROM lw)
SELECT feed, issue, count(*) AS n_rows FROM issues WHERE issue IS NOT NULL GROUP BY feed, issue"""

SQL["unlisted_measures"] = f"""WITH {LW}
SELECT CASE l_returnflag WHEN 'A' THEN 'Visits due to PM2.5' ELSE 'Ozone (O3)' END AS measure, count(*) AS n_rows
FROM lw WHERE l_returnflag IN ('A', 'N') GROUP BY 1"""

SQL["parse_dates_lenient"] = """
SELECT o_orderkey, CAST(TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS DATE) AS parsed_date,
       CAST(TRY_CAST(o_orderstatus AS TIMESTAMP) AS DATE) AS parsed_status,
       CAST(o_orderdate AS DATE) AS parsed_fmt,
       CASE WHEN o_orderkey % 7 <> 6 THEN CAST(o_orderdate AS DATE) END AS parsed_mixed
FROM orders"""

SQL["key_canonical"] = "SELECT c_custkey, lower(trim(c_mktsegment)) AS key FROM customer"

SQL["coerce_numeric"] = f"""
SELECT event_id,
       {coerce("regexp_extract(props, ':(.*)\\}', 1)")} AS k_num,
       {coerce('props')} AS props_num,
       {coerce("CAST(event_id AS VARCHAR) || 'd'")} AS suffix_num,
       {rnd(coerce("format('{:,.2f}', value)"))} AS grouped_num
FROM events"""

SQL["sanitize_names"] = """
SELECT DISTINCT Name, 'AQ_' || replace(replace(replace(replace(Name, ' ', '_'), '(', ''), ')', ''), '.', '') AS column_name
FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'Visits due to PM2.5' WHEN l_returnflag = 'N' THEN 'Ozone (O3)'
                  ELSE 'Nitrogen dioxide (NO2)' END AS Name
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""

SQL["filter_years"] = f"""WITH {OV}
SELECT dt AS Date, place AS borough, {r6('cnt', 'Count')} FROM ov
WHERE is_resp AND year(dt) IN (2000, 2001)"""

SQL["filter_valid_keys"] = f"""
SELECT * FROM (
  SELECT c_custkey AS request_id,
         CASE WHEN c_nationkey = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS borough,
         strftime(DATE '1995-01-01' + CAST((c_custkey * 37) % 2600 AS INTEGER), '%Y-%m-%d') AS date,
         CAST(20 + c_nationkey AS INTEGER) AS capacity
  FROM customer) WHERE borough IN {PLACES}"""

SQL["visits_daily_sum"] = f"""WITH {OV}
SELECT dt AS Date, place AS borough, {r6('sum(cnt)', 'Respiratory_Count')} FROM ov WHERE is_resp GROUP BY dt, place"""

SQL["visits_inner"] = f"""WITH {OV},
resp AS (SELECT dt, place, sum(cnt) AS rc FROM ov WHERE is_resp GROUP BY dt, place),
asth AS (SELECT dt, place, sum(cnt) AS ac FROM ov WHERE NOT is_resp GROUP BY dt, place)
SELECT r.dt AS Date, r.place AS borough, {r6('rc', 'Respiratory_Count')}, {r6('ac', 'Asthma_Count')}
FROM resp r JOIN asth a ON r.dt = a.dt AND r.place = a.place"""

SQL["health_daily"] = f"""WITH {HEALTH}
SELECT Date, borough, {sel_round(['Respiratory_Count', 'Asthma_Count', 'Total_Hospitalization'])}, year FROM health"""

SQL["weather_clean"] = f"""WITH {WEATHER}
SELECT Date, borough, {sel_round(['Temp_Max_C', 'Temp_Min_C', 'Humidity_Avg', 'WindSpeed_mps'])} FROM weather"""

SQL["airq_pivot"] = f"""WITH {LW}, {AIRQ}
SELECT Date, borough, {sel_round(['AQ_Nitrogen_dioxide_NO2', 'AQ_Ozone_O3', 'AQ_Visits_due_to_PM25'])} FROM airq"""

SQL["panel_weather_left"] = f"""WITH {HEALTH}, {WEATHER}
SELECT h.Date, h.borough, h.year,
       {sel_round(['Respiratory_Count', 'Asthma_Count', 'Total_Hospitalization'], 'h')},
       {sel_round(['Temp_Max_C', 'Temp_Min_C', 'Humidity_Avg', 'WindSpeed_mps'], 'w')}
FROM health h LEFT JOIN weather w ON h.Date = w.Date AND h.borough = w.borough"""

SQL["panel_merged"] = f"""WITH {PANEL}
SELECT Date, borough, year, {sel_round(PANEL_COLS)} FROM panel"""


# ---------------------------------------------------------------- imputation, lags, features

FILL_COLS = ["Temp_Max_C", "Temp_Min_C", "Humidity_Avg", "WindSpeed_mps",
             "AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3", "AQ_Visits_due_to_PM25"]
WF = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
WB = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"

IMPUTED = PANEL + ",\nimp0 AS (\n  SELECT Date, borough, year, Respiratory_Count, Asthma_Count, Total_Hospitalization,\n" + \
    ",\n".join(f"    coalesce(last_value({c} IGNORE NULLS) OVER wf, first_value({c} IGNORE NULLS) OVER wb) AS {c}"
               for c in FILL_COLS) + \
    f"\n  FROM panel WINDOW wf AS (PARTITION BY borough ORDER BY Date {WF}),\n" \
    f"                    wb AS (PARTITION BY borough ORDER BY Date {WB})),\n" + \
    "imputed AS (\n  SELECT Date, borough, year, Respiratory_Count, Asthma_Count, Total_Hospitalization,\n" + \
    ",\n".join(f"    coalesce({c}, (SELECT avg({c}) FROM imp0), 0) AS {c}" for c in FILL_COLS) + "\n  FROM imp0)"

LAG_COLS = ["Total_Hospitalization", "Respiratory_Count", "Asthma_Count", "Temp_Max_C", "Humidity_Avg",
            "WindSpeed_mps"]
PLACE_LIST = ["automobile", "building", "furniture", "household", "machinery"]

CALENDAR = ("CAST(month(Date) AS INTEGER) AS month, CAST(day(Date) AS INTEGER) AS day, "
            "CAST(isodow(Date) - 1 AS INTEGER) AS day_of_week, CAST(quarter(Date) AS INTEGER) AS quarter, "
            "CAST(isodow(Date) >= 6 AS INTEGER) AS is_weekend, "
            "CAST(floor((month(Date) % 12) / 3) + 1 AS INTEGER) AS season")
ONE_HOT = ", ".join(f"CAST(borough = '{p}' AS INTEGER) AS borough_{p}" for p in PLACE_LIST)
FRAME_LAGS = ", ".join(f"lag({c}, {k}) OVER (ORDER BY Date, borough) AS {c}_lag{k}"
                       for c in LAG_COLS for k in (1, 7))

FEATURES = IMPUTED + f""",
feat0 AS (SELECT *, {CALENDAR}, {ONE_HOT}, {FRAME_LAGS}, Temp_Max_C - Temp_Min_C AS Temp_Range FROM imputed),
features AS (
  SELECT *, CAST(Total_Hospitalization >= (SELECT quantile_cont(Total_Hospitalization, 0.75) FROM feat0) AS INTEGER)
            AS High_Risk,
         CASE WHEN year(Date) IN (1995, 1996, 1997, 1998) THEN 'train' WHEN year(Date) = 2000 THEN 'val'
              WHEN year(Date) = 2001 THEN 'test' END AS split
  FROM feat0)"""

FEATURE_NAMES = (["Temp_Max_C", "Temp_Min_C", "WindSpeed_mps", "Humidity_Avg", "AQ_Nitrogen_dioxide_NO2",
                  "AQ_Ozone_O3", "AQ_Visits_due_to_PM25", "month", "day", "day_of_week", "quarter",
                  "is_weekend", "season"] + [f"borough_{p}" for p in PLACE_LIST]
                 + [f"{c}_lag7" for c in LAG_COLS] + ["Temp_Range"])

FEATURE_OUT = (["Respiratory_Count", "Asthma_Count", "Total_Hospitalization"] + FILL_COLS
               + [f"{c}_lag{k}" for c in LAG_COLS for k in (1, 7)] + ["Temp_Range"])
FEATURE_INT = ["year", "month", "day", "day_of_week", "quarter", "is_weekend", "season"] + \
    [f"borough_{p}" for p in PLACE_LIST] + ["High_Risk"]

SQL["impute_series"] = f"""WITH {IMPUTED}
SELECT Date, borough, year, {sel_round(['Respiratory_Count', 'Asthma_Count', 'Total_Hospitalization'] + FILL_COLS)}
FROM imputed"""

SQL["impute_frame"] = f"""WITH {PANEL}
SELECT Date, borough, year, {sel_round(['Respiratory_Count', 'Asthma_Count', 'Total_Hospitalization'])},
  {", ".join(rnd(f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY borough, Date {WF}), "
                 f"first_value({c} IGNORE NULLS) OVER (ORDER BY borough, Date {WB}))") + f" AS {c}"
             for c in FILL_COLS)}
FROM panel"""

SPINE_NULL = """sp AS (
  SELECT borough, CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date
  FROM health GROUP BY borough),
s AS (
  SELECT sp.borough, sp.Date, h.v FROM sp
  LEFT JOIN (SELECT borough, Date, sum(Total_Hospitalization) AS v FROM health GROUP BY borough, Date) h
    ON sp.borough = h.borough AND sp.Date = h.Date)"""

SQL["interpolate_limited"] = f"""WITH {HEALTH}, {SPINE_NULL},
pos AS (SELECT *, row_number() OVER (PARTITION BY borough ORDER BY Date) AS p FROM s),
nb AS (
  SELECT *, last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER wf AS pa,
            last_value(v IGNORE NULLS) OVER wf AS va,
            first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER wb AS pb,
            first_value(v IGNORE NULLS) OVER wb AS vb
  FROM pos WINDOW wf AS (PARTITION BY borough ORDER BY Date {WF}), wb AS (PARTITION BY borough ORDER BY Date {WB}))
SELECT borough, Date, {rnd('''CASE WHEN v IS NOT NULL THEN v
  WHEN pa IS NOT NULL AND pb IS NOT NULL AND (p - pa <= 3 OR pb - p <= 3) THEN va + (vb - va) * (p - pa) / (pb - pa)
  WHEN pa IS NULL AND pb IS NOT NULL AND pb - p <= 3 THEN vb
  WHEN pb IS NULL AND pa IS NOT NULL AND p - pa <= 3 THEN va END''')} AS Total_Hospitalization
FROM nb"""

_WV = ["Temp_Max_C", "Humidity_Avg", "WindSpeed_mps"]
SQL["lag_features_series"] = f"""WITH {PANEL}
SELECT Date, borough, {sel_round(_WV + ['Temp_Min_C'])},
  {", ".join(r6(f"lag({c}, {k}) OVER (PARTITION BY borough ORDER BY Date)", f"{c}_lag{k}")
             for c in _WV for k in (1, 2, 3))},
  {", ".join(r6(c, f"{c}_same_day") for c in _WV)}
FROM panel"""

SQL["lag_features_frame"] = f"""WITH {PANEL}
SELECT Date, borough, year,
  {sel_round(['Respiratory_Count', 'Asthma_Count', 'Total_Hospitalization', 'Temp_Max_C', 'Temp_Min_C',
              'Humidity_Avg', 'WindSpeed_mps'])},
  {", ".join(r6(f"lag({c}, {k}) OVER (ORDER BY Date, borough)", f"{c}_lag{k}") for c in LAG_COLS for k in (1, 7))}
FROM panel"""

_RC = ["Total_Hospitalization", "Temp_Max_C", "Humidity_Avg"]
SQL["rolling_mean_shift"] = f"""WITH {PANEL}
SELECT Date, borough, {sel_round(_RC)},
  {", ".join(r6(f"avg({c}) OVER (PARTITION BY borough ORDER BY Date ROWS BETWEEN 9 PRECEDING AND 3 PRECEDING)",
                f"{c}_roll7") for c in _RC)}
FROM panel"""

SQL["calendar_features"] = f"""WITH {HEALTH}
SELECT Date, borough, year, {CALENDAR} FROM health"""

SQL["one_hot_key"] = f"""WITH {HEALTH}
SELECT Date, borough, {ONE_HOT} FROM health"""

SQL["range_features"] = f"""WITH {WEATHER}
SELECT Date, borough, {r6('Temp_Max_C - Temp_Min_C', 'Temp_Range')} FROM weather"""

SQL["quantile_threshold"] = f"""WITH {HEALTH}
SELECT {", ".join(r6(f"quantile_cont(Total_Hospitalization, {q})", f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75))}
FROM health"""

SQL["high_risk_target"] = f"""WITH {PANEL}
SELECT Date, borough, {r6('Total_Hospitalization', 'Total_Hospitalization')},
  CAST(Total_Hospitalization >= (SELECT quantile_cont(Total_Hospitalization, 0.75) FROM panel) AS INTEGER) AS High_Risk
FROM panel"""

SQL["temporal_split"] = f"""WITH {HEALTH}
SELECT Date, borough, CASE WHEN year(Date) IN (1995, 1996, 1997, 1998) THEN 'train' WHEN year(Date) = 2000 THEN 'val'
  WHEN year(Date) = 2001 THEN 'test' END AS split FROM health"""

SQL["features"] = f"""WITH {FEATURES}
SELECT Date, borough, {", ".join(f"CAST(year(Date) AS INTEGER) AS year" if c == "year" else c for c in FEATURE_INT)},
  {sel_round(FEATURE_OUT)}
FROM features"""

SQL["feature_matrix"] = f"""WITH {FEATURES}
SELECT Date, borough, {r6('Total_Hospitalization', 'Total_Hospitalization')}, High_Risk, split,
  {", ".join(r6(f"coalesce(CAST({c} AS DOUBLE), 0)", c) for c in FEATURE_NAMES)}
FROM features WHERE split IS NOT NULL"""

_ZC = ["Temp_Max_C", "Humidity_Avg", "WindSpeed_mps", "day_of_week", "borough_building"]
SQL["standardize"] = f"""WITH {FEATURES}, f AS (SELECT * FROM features WHERE split IS NOT NULL)
SELECT Date, borough, split,
  {", ".join(r6(f"({c} - (SELECT avg({c}) FROM f WHERE split = 'train')) / "
                f"coalesce(nullif((SELECT stddev_pop({c}) FROM f WHERE split = 'train'), 0), 1)", f"{c}_z")
             for c in _ZC)}
FROM f"""

SQL["feature_manifest"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', {i})" for i, n in enumerate(FEATURE_NAMES)) + ") t(Feature_Name, Feature_Index)"


# ---------------------------------------------------------------- exploration / series

SERIES = HEALTH + f""",
sp0 AS (SELECT Date, borough, Total_Hospitalization, Asthma_Count FROM health WHERE borough IN {PLACES})"""


def spine_zero(col: str) -> str:
    return f"""spz AS (
  SELECT borough, CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date
  FROM sp0 GROUP BY borough),
z AS (
  SELECT spz.borough, spz.Date, coalesce(d.v, 0) AS v FROM spz
  LEFT JOIN (SELECT borough, Date, sum({col}) AS v FROM sp0 GROUP BY borough, Date) d
    ON spz.borough = d.borough AND spz.Date = d.Date)"""


SQL["daily_spine_sum"] = f"""WITH {SERIES}, {spine_zero('Total_Hospitalization')}
SELECT borough, Date, {r6('v', 'Total_Hospitalization')} FROM z"""

SQL["min_length_series"] = f"""WITH ev AS (
  SELECT CAST(ts AS DATE) AS Date, event_type AS borough, sum(value) AS value FROM events GROUP BY 1, 2)
SELECT Date, borough, {r6('value', 'value')} FROM ev
WHERE borough IN (SELECT borough FROM ev GROUP BY borough HAVING count(value) >= 14)"""

SQL["winsorize_iqr"] = f"""WITH {SERIES},
b AS MATERIALIZED (SELECT borough, quantile_cont(Total_Hospitalization, [0.25, 0.75]) AS q FROM sp0 GROUP BY borough),
c AS MATERIALIZED (SELECT borough, q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi FROM b)
SELECT s.Date, s.borough, {r6('s.Asthma_Count', 'Asthma_Count')}, {r6('least(greatest(s.Total_Hospitalization, c.lo), c.hi)', 'Total_Hospitalization')}
FROM sp0 AS s JOIN c ON s.borough = c.borough"""

SQL["winsorize_percentile"] = f"""WITH {SERIES},
b AS MATERIALIZED (SELECT borough, quantile_cont(Total_Hospitalization, [0.01, 0.99]) AS q FROM sp0 GROUP BY borough),
c AS MATERIALIZED (SELECT borough, q[1] AS lo, q[2] AS hi FROM b)
SELECT s.Date, s.borough, {r6('s.Asthma_Count', 'Asthma_Count')}, {r6('least(greatest(s.Total_Hospitalization, c.lo), c.hi)', 'Total_Hospitalization')}
FROM sp0 AS s JOIN c ON s.borough = c.borough"""

SQL["winsor_log_series"] = f"""WITH {SERIES}, {spine_zero('Total_Hospitalization')},
b AS (SELECT borough, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM z GROUP BY borough)
SELECT z.borough, Date,
  {r6('ln(1 + greatest(least(greatest(v, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 0))', 'Total_Hospitalization')}
FROM z JOIN b ON z.borough = b.borough"""

SQL["additive_decompose"] = f"""WITH {SERIES}, {spine_zero('Asthma_Count')},
t AS (
  SELECT borough, Date, v AS observed,
    CASE WHEN count(v) OVER w = 7 THEN avg(v) OVER w END AS trend,
    (row_number() OVER (PARTITION BY borough ORDER BY Date) - 1) % 7 AS phase
  FROM z WINDOW w AS (PARTITION BY borough ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ph AS (SELECT borough, phase, avg(observed - trend) AS pm FROM t GROUP BY borough, phase),
phc AS (SELECT borough, phase, pm - avg(pm) OVER (PARTITION BY borough) AS seasonal FROM ph)
SELECT t.borough, Date, {r6('observed', 'observed')}, {r6('trend', 'trend')}, {r6('seasonal', 'seasonal')},
  {r6('observed - trend - seasonal', 'resid')}
FROM t JOIN phc ON t.borough = phc.borough AND t.phase = phc.phase"""

_FIT_T = ["Total_Hospitalization", "Asthma_Count"]
_FIT_V = ["Temp_Max_C", "Temp_Min_C", "WindSpeed_mps", "Humidity_Avg"]
SQL["weather_linear_fit"] = f"""WITH {PANEL}, long AS (
  {" UNION ALL ".join(f"SELECT '{t}' AS target, '{v}' AS variable, {t} AS y, {v} AS x FROM panel"
                      for t in _FIT_T for v in _FIT_V)})
SELECT target, variable, {r6('regr_slope(y, x)', 'slope')}, {r6('regr_intercept(y, x)', 'intercept')},
  {r6('regr_r2(y, x)', 'r2')}, CAST(regr_count(y, x) AS BIGINT) AS n
FROM long GROUP BY target, variable"""

_MM = ["Total_Hospitalization", "Asthma_Count", "Temp_Max_C"]
SQL["monthly_means"] = f"""WITH {PANEL},
ms AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(Date)), date_trunc('month', max(Date)),
                                           INTERVAL 1 MONTH)) AS DATE) AS m FROM panel),
g AS (SELECT CAST(date_trunc('month', Date) AS DATE) AS m, {", ".join(f"avg({c}) AS {c}" for c in _MM)}
      FROM panel GROUP BY 1)
SELECT last_day(ms.m) AS Date, {sel_round(_MM, 'g')} FROM ms LEFT JOIN g ON ms.m = g.m"""

SQL["three_month_means"] = f"""WITH {PANEL},
f AS (SELECT CAST(date_trunc('month', min(Date)) AS DATE) AS first FROM panel),
ms AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(Date)), date_trunc('month', max(Date)),
                                           INTERVAL 1 MONTH)) AS DATE) AS m FROM panel),
bins AS (SELECT DISTINCT CAST(ceil(date_diff('month', f.first, ms.m) / 3) AS INTEGER) AS bin FROM ms, f),
g AS (SELECT CAST(ceil(date_diff('month', f.first, CAST(date_trunc('month', Date) AS DATE)) / 3) AS INTEGER) AS bin,
             {", ".join(f"avg({c}) AS {c}" for c in _MM)}
      FROM panel, f GROUP BY 1)
SELECT last_day(CAST(f.first + to_months(bins.bin * 3) AS DATE)) AS Date, {sel_round(_MM, 'g')}
FROM bins CROSS JOIN f LEFT JOIN g ON bins.bin = g.bin"""

SQL["monthly_by_key"] = f"""WITH {PANEL}
SELECT borough, last_day(Date) AS Date, {r6('sum(Total_Hospitalization)', 'Total_Hospitalization')},
  {r6('sum(Respiratory_Count)', 'Respiratory_Count')}, {r6('avg(Temp_Max_C)', 'Temp_Max_C')},
  {r6('avg(Humidity_Avg)', 'Humidity_Avg')}, {r6('avg(WindSpeed_mps)', 'WindSpeed_mps')}
FROM panel GROUP BY borough, last_day(Date)"""

_MJ = ["Respiratory_Count", "Temp_Max_C", "Humidity_Avg"]
SQL["monthly_join_back"] = f"""WITH {PANEL}
SELECT Date, borough, {sel_round(_MJ)},
  {", ".join(r6(f"{'sum' if c.endswith('_Count') else 'avg'}({c}) OVER (PARTITION BY borough, date_trunc('month', Date))", f"{c}_monthly") for c in _MJ)}
FROM panel"""


# ---------------------------------------------------------------- impact and profiling

EXTREME = "(coalesce(Temp_Max_C > 30, false) OR coalesce(Temp_Min_C < 0, false) OR coalesce(Humidity_Avg > 80, false))"

SQL["extreme_flag"] = f"""WITH {PANEL} SELECT Date, borough, CAST({EXTREME} AS INTEGER) AS is_extreme FROM panel"""

SQL["extreme_totals"] = f"""WITH {PANEL}
SELECT borough, {r6('sum(Total_Hospitalization)', 'extreme_total')} FROM panel WHERE {EXTREME} GROUP BY borough"""

SQL["extreme_uplift_by_key"] = f"""WITH {PANEL}, g AS (
  SELECT borough, avg(Total_Hospitalization) FILTER (WHERE {EXTREME}) AS extreme_avg,
         avg(Total_Hospitalization) FILTER (WHERE NOT {EXTREME}) AS normal_avg,
         count(*) FILTER (WHERE {EXTREME}) AS n_extreme_rows, count(*) FILTER (WHERE NOT {EXTREME}) AS n_normal_rows
  FROM panel GROUP BY borough)
SELECT borough, {r6('extreme_avg', 'extreme_avg')}, {r6('normal_avg', 'normal_avg')}, n_extreme_rows, n_normal_rows,
  {r6('(extreme_avg - normal_avg) / nullif(normal_avg, 0) * 100', 'pct_change')}
FROM g WHERE n_extreme_rows > 0 AND n_normal_rows > 0"""


def exposure_sql(exposures: dict, base: str, measures: list) -> str:
    parts = []
    for e, cond in exposures.items():
        for m in measures:
            parts.append(f"""SELECT '{e}' AS exposure, '{m}' AS measure,
  avg({m}) FILTER (WHERE coalesce({cond}, false)) AS exposed_avg, avg({m}) FILTER (WHERE coalesce({base}, false)) AS baseline_avg,
  count(*) FILTER (WHERE coalesce({cond}, false)) AS n_rows,
  count(DISTINCT CASE WHEN coalesce({cond}, false) THEN Date END) AS n_days,
  count(*) FILTER (WHERE coalesce({base}, false)) AS n_baseline_rows FROM panel""")
    return f"""WITH {PANEL}, t AS ({" UNION ALL ".join(parts)})
SELECT exposure, measure, {r6('exposed_avg', 'exposed_avg')}, {r6('baseline_avg', 'baseline_avg')}, n_rows, n_days,
  n_baseline_rows, {r6('(exposed_avg - baseline_avg) / nullif(baseline_avg, 0) * 100', 'pct_change')}
FROM t WHERE n_rows > 0"""


SQL["temperature_impact"] = exposure_sql({"heat": "Temp_Max_C > 30", "cold": "Temp_Min_C < 0"},
                                         "Temp_Max_C BETWEEN 10 AND 25",
                                         ["Total_Hospitalization", "Respiratory_Count", "Asthma_Count"])
SQL["humidity_impact"] = exposure_sql({"high_humidity": "Humidity_Avg > 80"}, "Humidity_Avg BETWEEN 40 AND 70",
                                      ["Total_Hospitalization", "Asthma_Count"])


def exposure_cte(cols: list) -> str:
    num = " + ".join(f"coalesce({c}, 0)" for c in cols)
    den = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"""e0 AS (SELECT *, ({num}) / nullif({den}, 0) AS exposure FROM panel),
e AS (SELECT * FROM e0 WHERE exposure > 0),
eh AS (SELECT *, CAST(exposure >= (SELECT quantile_cont(exposure, 0.75) FROM e) AS INTEGER) AS is_high FROM e)"""


PM = ["AQ_Visits_due_to_PM25"]
AQC = ["AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3"]

SQL["high_exposure_days"] = f"""WITH {PANEL}, {exposure_cte(PM)}
SELECT Date, borough, {r6('exposure', 'exposure')}, is_high FROM eh"""

SQL["high_pm_totals"] = f"""WITH {PANEL}, {exposure_cte(PM)}
SELECT borough, {r6('sum(Total_Hospitalization)', 'high_total')} FROM eh WHERE is_high = 1 GROUP BY borough"""

SQL["high_aq_totals"] = f"""WITH {PANEL}, {exposure_cte(AQC)}
SELECT borough, {r6('sum(Total_Hospitalization)', 'high_total')} FROM eh WHERE is_high = 1 GROUP BY borough"""

SQL["pm_uplift_by_key"] = f"""WITH {PANEL}, {exposure_cte(PM)}, g AS (
  SELECT borough, avg(Total_Hospitalization) FILTER (WHERE is_high = 1) AS high_avg,
         avg(Total_Hospitalization) FILTER (WHERE is_high = 0) AS normal_avg,
         count(*) FILTER (WHERE is_high = 1) AS n_high_rows, count(*) FILTER (WHERE is_high = 0) AS n_normal_rows
  FROM eh GROUP BY borough)
SELECT borough, {r6('high_avg', 'high_avg')}, {r6('normal_avg', 'normal_avg')}, n_high_rows, n_normal_rows,
  {r6('(high_avg - normal_avg) / nullif(normal_avg, 0) * 100', 'pct_change')}, {r6('high_avg - normal_avg', 'abs_change')}
FROM g WHERE n_high_rows > 0 AND n_normal_rows > 0"""

RANK = f"""{PANEL}, kr AS (
  SELECT borough, sum(Total_Hospitalization) AS total_cases, avg(Total_Hospitalization) AS avg_daily_cases,
         sum(Asthma_Count) AS asthma_cases, sum(Respiratory_Count) AS respiratory_cases, count(*) AS n_rows
  FROM panel GROUP BY borough),
krr AS (SELECT *, total_cases * 100.0 / sum(total_cases) OVER () AS share_pct,
               CAST(row_number() OVER (ORDER BY total_cases DESC, borough ASC) AS INTEGER) AS rank FROM kr)"""

SQL["key_ranking"] = f"""WITH {RANK}
SELECT borough, {sel_round(['total_cases', 'avg_daily_cases', 'asthma_cases', 'respiratory_cases', 'share_pct'])},
  n_rows, rank FROM krr"""
SQL["totals_by_key"] = f"WITH {RANK} SELECT borough, {r6('total_cases', 'total_cases')}, rank FROM krr"
SQL["daily_avg_by_key"] = f"WITH {RANK} SELECT borough, {r6('avg_daily_cases', 'avg_daily_cases')}, n_rows FROM krr"
SQL["breakdown_by_key"] = f"""WITH {RANK}
SELECT borough, {sel_round(['asthma_cases', 'respiratory_cases', 'total_cases'])} FROM krr"""
SQL["share_of_total"] = f"WITH {RANK} SELECT borough, {r6('share_pct', 'share_pct')} FROM krr"

SQL["regional_summary"] = f"""WITH {PANEL}
SELECT borough AS Borough, {r6('sum(Total_Hospitalization)', 'Total_Cases')}, {r6('sum(Asthma_Count)', 'Asthma_Cases')},
  {r6('sum(Respiratory_Count)', 'Respiratory_Cases')}, {r6('avg(Total_Hospitalization)', 'Avg_Daily_Cases')}
FROM panel GROUP BY borough"""

SQL["regional_headline"] = f"""WITH {PANEL}, s AS (
  SELECT borough AS b, sum(Total_Hospitalization) AS t, sum(Asthma_Count) AS a, sum(Respiratory_Count) AS r,
         avg(Total_Hospitalization) AS d FROM panel GROUP BY borough)
SELECT (SELECT b FROM s ORDER BY t DESC, b LIMIT 1) AS top_total_key,
       (SELECT b FROM s ORDER BY a DESC, b LIMIT 1) AS top_asthma_key,
       (SELECT b FROM s ORDER BY r DESC, b LIMIT 1) AS top_respiratory_key,
       (SELECT b FROM s ORDER BY d DESC, b LIMIT 1) AS top_daily_avg_key,
       {r6('max(t)', 'top_total_cases')}, {r6('max(a)', 'top_asthma_cases')}, {r6('max(r)', 'top_respiratory_cases')},
       {r6('max(d)', 'top_daily_avg')}, {r6('sum(t)', 'grand_total')}, CAST(floor(avg(t)) AS BIGINT) AS mean_per_key,
       (SELECT min(Date) FROM panel) AS first_date, (SELECT max(Date) FROM panel) AS last_date
FROM s"""

_ALLP = ["Date", "borough", "year"] + PANEL_COLS
SQL["missing_profile"] = f"""WITH {PANEL}
{" UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count({c}) AS n_missing, count(*) AS n_rows FROM panel" for c in _ALLP)}"""

_DW = ["Temp_Max_C", "Temp_Min_C", "Humidity_Avg", "WindSpeed_mps"]
SQL["describe_numeric"] = f"""WITH {WEATHER}
{" UNION ALL ".join(f'''SELECT '{c}' AS column, count({c}) AS count, {r6(f"avg({c})", "mean")}, {r6(f"stddev_samp({c})", "std")},
  {r6(f"min({c})", "min")}, {r6(f"quantile_cont({c}, 0.25)", "p25")}, {r6(f"quantile_cont({c}, 0.5)", "p50")},
  {r6(f"quantile_cont({c}, 0.75)", "p75")}, {r6(f"max({c})", "max")} FROM weather''' for c in _DW)}"""

SQL["value_counts"] = f"""WITH {PANEL}, h AS (
  SELECT CAST(Total_Hospitalization >= (SELECT quantile_cont(Total_Hospitalization, 0.75) FROM panel) AS INTEGER) AS High_Risk
  FROM panel)
SELECT High_Risk, count(*) AS count FROM h GROUP BY High_Risk"""

SQL["data_summary"] = f"""WITH {PANEL}
SELECT count(*) AS n_rows, min(Date) AS first_date, max(Date) AS last_date, count(DISTINCT Date) AS n_days,
  array_to_string(list_sort(list(DISTINCT CAST(year(Date) AS VARCHAR))), ',') AS years,
  count(DISTINCT borough) AS n_keys, array_to_string(list_sort(list(DISTINCT borough)), ',') AS keys,
  {r6('sum(Total_Hospitalization)', 'sum_Total_Hospitalization')}, {r6('sum(Asthma_Count)', 'sum_Asthma_Count')},
  {r6('sum(Respiratory_Count)', 'sum_Respiratory_Count')}
FROM panel"""


def corr_sql(x: str, y: str) -> str:
    return (f"covar_pop({x}, {y}) / nullif(stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END) * "
            f"stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END), 0)")


SQL["corr_matrix"] = f"""WITH {PANEL}
{" UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, {r6(corr_sql(a, b), 'corr')} FROM panel"
                    for a in PANEL_COLS for b in PANEL_COLS)}"""

SQL["corr_listwise"] = f"""WITH {PANEL}, c AS (SELECT * FROM panel WHERE {" AND ".join(f"{x} IS NOT NULL" for x in PANEL_COLS)})
{" UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, {r6(corr_sql(a, b), 'corr')} FROM c"
                    for a in PANEL_COLS for b in PANEL_COLS)}"""

def _top(target: str) -> str:
    each = " UNION ALL ".join(f"SELECT '{a}' AS variable, {r6(corr_sql(a, target), 'corr')} FROM panel" for a in PANEL_COLS)
    return f"SELECT * FROM (SELECT '{target}' AS target, * FROM ({each}) ORDER BY corr DESC NULLS LAST, variable LIMIT 10)"


SQL["corr_target_top"] = f"WITH {PANEL} {_top('Total_Hospitalization')} UNION ALL {_top('Respiratory_Count')}"

_LAGV = [f"{c}_lag{k}" for c in _WV for k in (1, 2, 3)]
_FILT = _WV + _LAGV + [f"{c}_same_day" for c in _WV] + [f"{c}_monthly" for c in _WV]
SQL["corr_target_filtered"] = f"""WITH {PANEL}, lagged AS (
  SELECT Respiratory_Count, {", ".join(_WV)},
    {", ".join(f"avg({c}) OVER (PARTITION BY borough, date_trunc('month', Date)) AS {c}_monthly" for c in _WV)},
    {", ".join(f"lag({c}, {k}) OVER (PARTITION BY borough ORDER BY Date) AS {c}_lag{k}" for c in _WV for k in (1, 2, 3))},
    {", ".join(f"{c} AS {c}_same_day" for c in _WV)}
  FROM panel),
c AS (SELECT * FROM lagged WHERE Respiratory_Count IS NOT NULL AND {" AND ".join(f"{x} IS NOT NULL" for x in _FILT)})
{" UNION ALL ".join(f"SELECT '{a}' AS variable, {r6(corr_sql(a, 'Respiratory_Count'), 'corr')} FROM c" for a in _FILT)}"""

SQL["service_stats"] = f"""WITH {IMPUTED}
SELECT count(*) AS total_records, {r6('avg(Total_Hospitalization)', 'avg_daily_admissions')},
  array_to_string(list_sort(list(DISTINCT borough)), ',') AS keys, min(Date) AS first_date, max(Date) AS last_date
FROM imputed"""


# ---------------------------------------------------------------- metrics on scored rows

SCORED = """scored AS (
  SELECT event_id AS id, event_type AS model,
         CASE WHEN user_id % 5 <= 2 THEN 'Train' WHEN user_id % 5 = 3 THEN 'Val' ELSE 'Test' END AS dataset,
         CAST(value >= 50 AS INTEGER) AS label, CAST((event_id * 7919) % 100 AS DOUBLE) / 100 AS score,
         value AS y, value * 0.8 + (event_id * 31) % 20 AS yhat
  FROM events)"""

SCORE_COUNTS = SCORED + """,
sc0 AS (SELECT model, dataset, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS n
        FROM scored GROUP BY model, dataset, score),
sc AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY model, dataset ORDER BY score
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
              coalesce(sum(p) OVER (PARTITION BY model, dataset ORDER BY score
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pb,
              sum(n) OVER (PARTITION BY model, dataset) AS NN, sum(p) OVER (PARTITION BY model, dataset) AS PP
       FROM sc0),
au AS (SELECT model, dataset, sum(p * (nb + n / 2.0)) / (max(PP) * max(NN)) AS AUROC FROM sc GROUP BY model, dataset)"""

CLF = SCORE_COUNTS + """,
cm AS (
  SELECT model, dataset, count(*) AS nn,
         count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score > 0.5 AND label <> 1) AS fp,
         count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn,
         count(*) FILTER (WHERE CAST(score > 0.5 AS INTEGER) = label) AS ok
  FROM scored GROUP BY model, dataset),
clf AS (
  SELECT cm.model, cm.dataset, ok / nn AS Accuracy, coalesce(tp / nullif(tp + fn, 0), 0) AS Recall,
         coalesce(tp / nullif(tp + fp, 0), 0) AS Precision, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS F1,
         au.AUROC
  FROM cm LEFT JOIN au ON cm.model = au.model AND cm.dataset = au.dataset)"""

REG = SCORED + """,
reg AS (
  SELECT model, dataset, sqrt(avg((y - yhat) * (y - yhat))) AS RMSE, avg(abs(y - yhat)) AS MAE,
         1 - sum((y - yhat) * (y - yhat)) / nullif(count(y) * var_pop(y), 0) AS R2,
         avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END) * 100 AS MAPE
  FROM scored GROUP BY model, dataset)"""

SQL["classification_metrics"] = f"""WITH {CLF}
SELECT model, dataset, {r6('Accuracy', 'Accuracy')}, {r6('Recall', 'Recall')}, {r6('Precision', 'Precision')},
  {r6('F1', '"F1-Score"')}, {r6('AUROC', 'AUROC')} FROM clf"""

SQL["auroc"] = f"WITH {SCORE_COUNTS} SELECT model, dataset, {r6('AUROC', 'AUROC')} FROM au"

SQL["regression_metrics"] = f"""WITH {REG}
SELECT model, dataset, {sel_round(['RMSE', 'MAE', 'R2', 'MAPE'])} FROM reg"""

SQL["roc_curve"] = f"""WITH {SCORE_COUNTS}
SELECT model, dataset, {r6('score', 'threshold')}, {r6('(NN - nb) / NN', 'fpr')}, {r6('(PP - pb) / PP', 'tpr')}
FROM sc WHERE dataset = 'Test'"""

SQL["confusion_matrix"] = f"""WITH {SCORED}
SELECT g.model, g.dataset, a.actual, a.predicted,
  count(s.id) AS count
FROM (SELECT DISTINCT model, dataset FROM scored) g
CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(actual, predicted)
LEFT JOIN scored s ON s.model = g.model AND s.dataset = g.dataset
  AND CAST(s.label = 1 AS INTEGER) = a.actual AND CAST(s.score > 0.5 AS INTEGER) = a.predicted
GROUP BY g.model, g.dataset, a.actual, a.predicted"""

BEST = CLF + ",\n" + REG.replace(SCORED + ",", "") + """,
bc AS (SELECT * FROM clf WHERE dataset = 'Test' ORDER BY AUROC DESC NULLS LAST, model LIMIT 1),
br AS (SELECT * FROM reg WHERE dataset = 'Test' ORDER BY R2 DESC NULLS LAST, model LIMIT 1)"""

SQL["best_model"] = f"""WITH {BEST}
SELECT 'classification' AS task, model, 'AUROC' AS metric, {r6('AUROC', 'value')} FROM bc
UNION ALL SELECT 'regression', model, 'R2', {rnd('R2')} FROM br"""

SQL["residuals"] = f"""WITH {BEST}
SELECT id, {r6('y', 'actual')}, {r6('yhat', 'predicted')}, {r6('y - yhat', 'residual')}
FROM scored WHERE dataset = 'Test' AND model = (SELECT model FROM br)"""

SQL["key_findings"] = f"""WITH {PANEL}, {exposure_cte(PM)}, g AS (
  SELECT borough, avg(Total_Hospitalization) FILTER (WHERE is_high = 1) AS high_avg,
         avg(Total_Hospitalization) FILTER (WHERE is_high = 0) AS normal_avg,
         count(*) FILTER (WHERE is_high = 1) AS nh, count(*) FILTER (WHERE is_high = 0) AS nn
  FROM eh GROUP BY borough),
base AS (SELECT avg(Total_Hospitalization) FILTER (WHERE Temp_Max_C BETWEEN 10 AND 25) AS mild,
                avg(Total_Hospitalization) FILTER (WHERE Temp_Max_C > 30) AS heat,
                avg(Total_Hospitalization) FILTER (WHERE Temp_Min_C < 0) AS cold,
                avg(Asthma_Count) FILTER (WHERE Humidity_Avg BETWEEN 40 AND 70) AS hn,
                avg(Asthma_Count) FILTER (WHERE Humidity_Avg > 80) AS hh FROM panel),
{BEST.split("WITH ", 1)[-1] if False else BEST}
SELECT 'pm25_uplift_pct_' || borough AS finding, {r6('(high_avg - normal_avg) / nullif(normal_avg, 0) * 100', 'value')}
FROM g WHERE nh > 0 AND nn > 0
UNION ALL SELECT 'heat_total_pct', {rnd('(heat - mild) / nullif(mild, 0) * 100')} FROM base
UNION ALL SELECT 'cold_total_pct', {rnd('(cold - mild) / nullif(mild, 0) * 100')} FROM base
UNION ALL SELECT 'humidity_asthma_pct', {rnd('(hh - hn) / nullif(hn, 0) * 100')} FROM base
UNION ALL SELECT 'best_clf_accuracy', {rnd('Accuracy')} FROM bc
UNION ALL SELECT 'best_clf_auroc', {rnd('AUROC')} FROM bc
UNION ALL SELECT 'best_reg_r2', {rnd('R2')} FROM br
UNION ALL SELECT 'best_reg_mae', {rnd('MAE')} FROM br"""


# ---------------------------------------------------------------- scoring

VR = """rq AS (
  SELECT c_custkey AS request_id, CASE WHEN c_nationkey = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS borough,
         strftime(DATE '1995-01-01' + CAST((c_custkey * 37) % 2600 AS INTEGER), '%Y-%m-%d') AS date,
         CAST(20 + c_nationkey AS INTEGER) AS capacity
  FROM customer),
vr0 AS (SELECT request_id, lower(trim(borough)) AS borough, date, coalesce(capacity, 80) AS capacity,
               CAST(TRY_STRPTIME(date, '%Y-%m-%d') AS DATE) AS req_date FROM rq),
vr AS (SELECT *, CASE WHEN borough IS NULL OR date IS NULL THEN 'missing field'
                      WHEN borough NOT IN """ + PLACES + """ THEN 'unknown key'
                      WHEN req_date IS NULL THEN 'bad date' END AS error FROM vr0),
ok AS (SELECT * FROM vr WHERE error IS NULL)"""


def answered(select: str, carried: str = "request_id, borough, req_date") -> str:
    """The records of accepted requests (``select``, after SELECT) and a failed record for each rejected one."""
    return (f"SELECT {select}\nUNION ALL BY NAME\n"
            f"SELECT {carried}, false AS success, error FROM vr WHERE error IS NOT NULL")


_TRUE = "true AS success, CAST(NULL AS VARCHAR) AS error"

HIST_AVG = """ha_h AS (SELECT borough, month(Date) AS m, day(Date) AS d, Total_Hospitalization AS t FROM imputed),
ha_md AS (SELECT borough, m, d, avg(t) AS a FROM ha_h GROUP BY borough, m, d),
ha_mo AS (SELECT borough, m, avg(t) AS a FROM ha_h GROUP BY borough, m),
ha AS (SELECT ok.*, round_even(coalesce(ha_md.a, ha_mo.a), 2) AS historical_average FROM ok
       LEFT JOIN ha_md ON ok.borough = ha_md.borough AND month(ok.req_date) = ha_md.m AND day(ok.req_date) = ha_md.d
       LEFT JOIN ha_mo ON ok.borough = ha_mo.borough AND month(ok.req_date) = ha_mo.m)"""

FALLBACK = HIST_AVG + """,
fb AS (SELECT *, true AS success,
  CASE WHEN coalesce(historical_average, 0) <> 0 THEN historical_average ELSE 60.0 END AS expected_admissions,
  CASE WHEN coalesce(historical_average, 0) <> 0 THEN (CASE WHEN historical_average > 50 THEN 'Moderate' ELSE 'Low' END)
       ELSE 'Moderate' END AS risk_level,
  CASE WHEN coalesce(historical_average, 0) <> 0 THEN least(historical_average / 100.0, 0.95) ELSE 0.45 END
    AS risk_probability,
  CASE WHEN coalesce(historical_average, 0) <> 0 THEN 'Medium (Historical Data)' ELSE 'Low (Baseline)' END AS confidence
  FROM ha)"""

SQL["validate_requests"] = f"""WITH {VR}
SELECT request_id, borough, date, capacity, req_date, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error
FROM vr"""

SQL["nearest_date_join"] = f"""WITH {IMPUTED}, {VR},
hd AS (SELECT DISTINCT borough, Date FROM imputed),
c AS (SELECT v.request_id, h.Date,
             row_number() OVER (PARTITION BY v.request_id ORDER BY abs(date_diff('day', h.Date, v.req_date)), h.Date) AS rn
      FROM vr v JOIN hd h ON v.borough = h.borough WHERE v.req_date IS NOT NULL)
SELECT v.request_id, v.borough, v.req_date, c.Date AS matched_date,
       CAST(abs(date_diff('day', v.req_date, c.Date)) AS INTEGER) AS day_gap
FROM vr v LEFT JOIN c ON v.request_id = c.request_id AND c.rn = 1"""

SQL["historical_average"] = f"""WITH {IMPUTED}, {VR}, {HIST_AVG}
{answered(f"request_id, borough, req_date, {r6('historical_average', 'historical_average')}, {_TRUE} FROM ha")}"""

SQL["cascade_features"] = f"""WITH {IMPUTED}, {VR},
mo AS (SELECT borough, month(Date) AS m, {", ".join(f"avg({c}) AS {c}" for c in _WV)} FROM imputed GROUP BY 1, 2)
{answered(f"""ok.request_id, ok.borough, ok.req_date, {_TRUE},
  {", ".join(r6(f"CASE WHEN e.Date IS NOT NULL THEN e.{c} WHEN mo.m IS NOT NULL THEN mo.{c} ELSE 0 END", c) for c in _WV)},
  CASE WHEN e.Date IS NOT NULL THEN 'exact' WHEN mo.m IS NOT NULL THEN 'month' ELSE 'none' END AS match_level
FROM ok LEFT JOIN imputed e ON ok.borough = e.borough AND ok.req_date = e.Date
LEFT JOIN mo ON ok.borough = mo.borough AND month(ok.req_date) = mo.m""")}"""

SQL["risk_band"] = f"""WITH {SCORED}
SELECT id, model, dataset, CASE WHEN score >= 0.7 THEN 'High' WHEN score >= 0.4 THEN 'Moderate' ELSE 'Low' END AS risk_band,
  CASE WHEN score > 0.5 THEN 'High' ELSE 'Low' END AS binary_band FROM scored"""

SQL["score_fallback"] = f"""WITH {IMPUTED}, {VR}, {FALLBACK}
{answered(f"""request_id, borough, req_date, capacity, {r6('historical_average', 'historical_average')}, {_TRUE},
  {r6('expected_admissions', 'expected_admissions')}, risk_level, {r6('risk_probability', 'risk_probability')}, confidence,
  concat(upper(borough[1]), lower(borough[2:])) AS display_key, strftime(req_date, '%B %d, %Y') AS display_date
FROM fb""", "request_id, borough, req_date, capacity")}"""

SQL["score_capacity"] = f"""WITH {IMPUTED}, {VR}, {FALLBACK},
km AS (SELECT borough, avg(Total_Hospitalization) AS key_mean FROM imputed GROUP BY borough)
{answered(f"""request_id, fb.borough, req_date, capacity, {r6('expected_admissions', 'predicted_count')}, {_TRUE},
  CAST(greatest(0, ceil(expected_admissions - capacity)) AS INTEGER) AS additional_beds_needed,
  {r6('expected_admissions / capacity * 100', 'utilization_percent')},
  CASE WHEN ceil(expected_admissions - capacity) > 0 THEN 'CAPACITY EXCEEDED' ELSE 'WITHIN CAPACITY' END AS capacity_status,
  {r6('(expected_admissions / key_mean - 1) * 100', 'vs_key_mean_pct')}
FROM fb LEFT JOIN km ON fb.borough = km.borough""", "request_id, borough, req_date, capacity")}"""

SQL["score_error_fallback"] = f"""WITH {IMPUTED}, {VR},
hd AS (SELECT borough, Date, Total_Hospitalization FROM imputed),
pr AS (SELECT v.request_id, v.borough, v.req_date, h.Total_Hospitalization AS pred
       FROM vr v LEFT JOIN hd h ON v.borough = h.borough AND v.req_date = h.Date),
hm_h AS (SELECT borough, month(Date) AS m, day(Date) AS d, Total_Hospitalization AS t FROM imputed),
hm_md AS (SELECT borough, m, d, avg(t) AS a FROM hm_h GROUP BY borough, m, d),
hm_mo AS (SELECT borough, m, avg(t) AS a FROM hm_h GROUP BY borough, m),
p2 AS (SELECT pr.*, round_even(coalesce(hm_md.a, hm_mo.a), 2) AS hist FROM pr
       LEFT JOIN hm_md ON pr.borough = hm_md.borough AND month(pr.req_date) = hm_md.m AND day(pr.req_date) = hm_md.d
       LEFT JOIN hm_mo ON pr.borough = hm_mo.borough AND month(pr.req_date) = hm_mo.m)
SELECT request_id,
  CASE WHEN pred IS NOT NULL THEN true ELSE coalesce(hist, 0) <> 0 END AS success,
  {rnd("CASE WHEN pred IS NOT NULL THEN pred WHEN coalesce(hist, 0) <> 0 THEN hist ELSE 0 END")} AS expected_admissions,
  CASE WHEN pred IS NOT NULL THEN 'Model' WHEN coalesce(hist, 0) <> 0 THEN (CASE WHEN hist > 75 THEN 'High' ELSE 'Moderate' END)
       ELSE 'Unknown' END AS risk_level,
  CASE WHEN pred IS NOT NULL THEN 'High (ML Model)' WHEN coalesce(hist, 0) <> 0 THEN 'Medium (Historical)' ELSE 'Low' END
    AS confidence,
  {r6('hist', 'historical_average')}
FROM p2"""

SQL["score_interpretation"] = f"""WITH {IMPUTED}, {VR}, {FALLBACK},
i AS (SELECT *, floor(expected_admissions + 0.5) AS adm FROM fb)
{answered(f"""request_id, CAST(adm AS BIGINT) AS rounded_admissions, {r6('adm - historical_average', 'diff_vs_history')}, {_TRUE},
  CAST(floor(abs(adm - historical_average) + 0.5) AS BIGINT) AS abs_diff_rounded,
  CASE WHEN historical_average IS NULL THEN NULL WHEN abs(adm - historical_average) > 5 THEN
    (CASE WHEN adm - historical_average > 0 THEN 'higher' ELSE 'lower' END) ELSE 'aligned' END AS direction,
  {rnd("CASE WHEN historical_average IS NULL THEN NULL WHEN historical_average > 0 THEN (adm - historical_average) / historical_average * 100 ELSE 0 END")} AS pct_vs_history,
  CASE WHEN lower(risk_level) = 'high' THEN 'prepare for increased patient volume'
       WHEN lower(risk_level) = 'moderate' THEN 'standard operating procedures' ELSE 'lower than average volume' END AS advice
FROM i""", "request_id")}"""


# ---------------------------------------------------------------- stations

CATALOGUE = """cat AS (SELECT * FROM (VALUES ('building', 1, 'X1'), ('building', 2, '3'), ('machinery', 1, '1'),
  ('furniture', 1, '2'), ('household', 1, 'X2'), ('household', 2, '0'), ('automobile', 1, '4'))
  t(borough, priority, station_id)),
landed AS (SELECT CAST(s.s_nationkey AS VARCHAR) AS STATION, CAST(l.l_shipdate AS DATE) AS DATE,
                  CAST(year(l.l_shipdate) AS INTEGER) AS year, l.l_quantity AS TMAX,
                  CAST(30 + 10 * l.l_linenumber AS DOUBLE) AS RHAV
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
sel AS (SELECT borough, station_id, priority FROM (
          SELECT *, row_number() OVER (PARTITION BY borough ORDER BY priority, station_id) AS r
          FROM cat WHERE station_id IN (SELECT DISTINCT STATION FROM landed)) WHERE r = 1)"""

SQL["station_fallback"] = f"WITH {CATALOGUE} SELECT borough, station_id, CAST(priority AS INTEGER) AS priority FROM sel"

SQL["station_year_coverage"] = f"""WITH {CATALOGUE}
SELECT STATION, year, count(*) AS n_rows FROM landed WHERE STATION IN (SELECT station_id FROM cat) GROUP BY STATION, year"""

SQL["union_station_years"] = f"""WITH {CATALOGUE}
SELECT sel.borough, STATION, DATE, year, {r6('TMAX', 'TMAX')}, {r6('RHAV', 'RHAV')}
FROM landed JOIN sel ON landed.STATION = sel.station_id"""


# ---------------------------------------------------------------- exact kNN

SQL["clf_knn"] = """WITH v AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label >= 5 AS INTEGER) AS y, vec_id % 5 < 4 AS is_train
  FROM embeddings),
d AS (SELECT q.id, t.id AS tid, t.y, list_distance(q.x, t.x) AS dist FROM v q JOIN v t ON NOT q.is_train AND t.is_train),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, tid) AS rn FROM d)
SELECT id, """ + rnd("avg(y)") + """ AS probability, count(*) AS n_neighbours,
  CAST(avg(y) > 0.5 AS INTEGER) AS predicted
FROM r WHERE rn <= 5 GROUP BY id"""


# ---------------------------------------------------------------- remaining cleaning / exploration entries

SQL["drop_empty_columns"] = f"""WITH {LW}, {AIRQ}
SELECT Date, borough, {sel_round(['AQ_Nitrogen_dioxide_NO2', 'AQ_Ozone_O3', 'AQ_Visits_due_to_PM25'])} FROM airq"""

SQL["drop_constant_zero_columns"] = SQL["impute_series"]

SQL["airq_carry_forward"] = f"""WITH {IMPUTED}
SELECT Date, borough, {sel_round(['AQ_Nitrogen_dioxide_NO2', 'AQ_Ozone_O3', 'AQ_Visits_due_to_PM25'])} FROM imputed"""

SQL["rowwise_mean"] = f"""WITH {PANEL}
SELECT Date, borough, {rnd('''(coalesce(AQ_Nitrogen_dioxide_NO2, 0) + coalesce(AQ_Ozone_O3, 0)) /
  nullif(CAST(AQ_Nitrogen_dioxide_NO2 IS NOT NULL AS INTEGER) + CAST(AQ_Ozone_O3 IS NOT NULL AS INTEGER), 0)''')}
  AS AQ_composite FROM panel"""

SQL["format_labels"] = f"""WITH {VR}
{answered(f"""request_id, concat(upper(borough[1]), lower(borough[2:])) AS title_key, upper(borough) AS upper_key,
  strftime(req_date, '%Y-%m-%d') AS iso_date, strftime(req_date, '%B %d, %Y') AS long_date,
  dayname(req_date) AS weekday_name, {_TRUE}
FROM ok""", "request_id")}"""

# ---------------------------------------------------------------- sinks: what is read back is what was computed

SQL["sink_classification_results"] = SQL["classification_metrics"]
SQL["sink_regression_results"] = SQL["regression_metrics"]
SQL["sink_components"] = SQL["additive_decompose"]

# ---------------------------------------------------------------- split counts in closed form

SQL["stratified_split"] = f"""WITH {FEATURES},
n AS (SELECT High_Risk, count(*) AS n FROM features GROUP BY High_Risk),
c AS (SELECT High_Risk, n, CAST(round(n * 0.15) AS BIGINT) AS t FROM n),
d AS (SELECT High_Risk, n, t, CAST(round((n - t) * 0.176) AS BIGINT) AS v FROM c)
SELECT High_Risk, 'test' AS split, t AS n_rows FROM d UNION ALL SELECT High_Risk, 'val', v FROM d
UNION ALL SELECT High_Risk, 'train', n - t - v FROM d"""

SQL["stack_station_files"] = f"""
SELECT CAST(s_nationkey AS VARCHAR) AS STATION, CAST(l_shipdate AS DATE) AS DATE, CAST(year(l_shipdate) AS INTEGER) AS year,
       {r6('l_quantity', 'TMAX')}, {r6('CASE WHEN year(l_shipdate) >= 1998 THEN 30 + 10 * l_linenumber END', 'RHAV')}
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
