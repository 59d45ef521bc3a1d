"""SQL for DuckDB with the same columns and values as the queries."""

from __future__ import annotations

from tremora.operators.models import draw_params

RANGE_FROM, RANGE_TO = "2024-01-03 06:00:00", "2024-01-24 00:00:00"

# -- shared tables, written as WITH members ---------------------------------

READINGS = """readings AS (
  SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS "Date", strftime(ts, '%H:%M:%S') AS "Time",
         event_type AS "Measurement", value AS data, 'dev_' || (user_id % 2) AS device,
         'loc_' || (user_id % 4) AS location, date_trunc('second', ts)::TIMESTAMP AS datetime
  FROM events)"""

RATINGS = """ratings AS (
  SELECT 'dev_' || (user_id % 2) AS device, time_bucket(INTERVAL '20 minutes', ts) + INTERVAL '20 minutes' AS datetime,
         event_type AS "Metric", greatest(0.0::DOUBLE, 100.0::DOUBLE - 20 * floor(round(avg(value), 6) / 20)) AS "Rating"
  FROM events WHERE event_type IN ('error', 'purchase') GROUP BY ALL)"""

WIDE = READINGS + """, wide AS (
  SELECT device, datetime, location, avg(data) FILTER ("Measurement" = 'click') AS click,
         avg(data) FILTER ("Measurement" = 'signup') AS signup, avg(data) FILTER ("Measurement" = 'view') AS "view"
  FROM readings WHERE "Measurement" IN ('click', 'signup', 'view') GROUP BY device, datetime, location)"""

RATED = RATINGS + """, rated AS (
  SELECT device, datetime, avg("Rating") FILTER ("Metric" = 'error') AS error,
         avg("Rating") FILTER ("Metric" = 'purchase') AS purchase
  FROM ratings GROUP BY device, datetime)"""

FILLED = WIDE + """, filled AS (
  SELECT device, datetime, location, click, signup,
         last_value("view" IGNORE NULLS) OVER (PARTITION BY device, location ORDER BY datetime
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "view"
  FROM wide)"""


def _overlap(left: str) -> str:
    return f""", bounds AS (
  SELECT device, greatest(l.lo, r.lo) AS lo, least(l.hi, r.hi) AS hi
  FROM (SELECT device, min(datetime) AS lo, max(datetime) AS hi FROM {left} GROUP BY device) l
  FULL JOIN (SELECT device, min(datetime) AS lo, max(datetime) AS hi FROM rated GROUP BY device) r USING (device)),
left_rows AS (SELECT a.* FROM {left} a JOIN bounds b ON a.device = b.device AND a.datetime BETWEEN b.lo AND b.hi),
right_rows AS (SELECT a.* FROM rated a JOIN bounds b ON a.device = b.device AND a.datetime BETWEEN b.lo AND b.hi)"""


MERGED = FILLED + ", " + RATED + _overlap("filled") + """, merged AS (
  SELECT l.device, l.datetime, l.location, l.click, l.signup, l."view", r.error, r.purchase
  FROM left_rows l ASOF LEFT JOIN right_rows r ON l.device = r.device AND l.datetime <= r.datetime)"""

MARKED = MERGED + """, numbered AS MATERIALIZED (
  SELECT *, row_number() OVER w AS rn,
         lag({'e': error, 'p': purchase}) OVER w IS DISTINCT FROM {'e': error, 'p': purchase} AS changed
  FROM merged WINDOW w AS (PARTITION BY device, location ORDER BY datetime)),
walk AS (
  SELECT device, location, rn, datetime, datetime AS bucket_start, 1::BIGINT AS bucket_id FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.device, n.location, n.rn, n.datetime,
         CASE WHEN n.changed OR n.datetime >= w.bucket_start + INTERVAL '120 minutes' THEN n.datetime ELSE w.bucket_start END,
         w.bucket_id + CASE WHEN n.changed OR n.datetime >= w.bucket_start + INTERVAL '120 minutes' THEN 1 ELSE 0 END
  FROM walk w JOIN numbered n ON n.device = w.device AND n.location = w.location AND n.rn = w.rn + 1),
marked AS (
  SELECT n.*, w.bucket_id, w.bucket_start AS anchor
  FROM numbered n JOIN walk w USING (device, location, rn))"""


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f'round({expr} + 1e-9, {digits}) + 0.0 AS "{name or expr}"'


def _measure_stats(digits: int) -> str:
    return ", ".join(
        f'count("{m}") AS "{m}_count", ' + ", ".join(
            r(f'{f}("{m}")', f"{m}_{n}", digits) for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
        ) for m in ("click", "signup", "view")
    )


BUCKETS = MARKED + f""", summary AS (
  SELECT device, location, bucket_id, {_measure_stats(6)},
         arg_min(error, datetime) FILTER (error IS NOT NULL) AS error_rating,
         arg_min(purchase, datetime) FILTER (purchase IS NOT NULL) AS purchase_rating,
         min(datetime) AS bucket_start, max(datetime) AS bucket_end
  FROM marked GROUP BY device, location, bucket_id)"""

WAVES = """waves AS (
  SELECT vec_id, 'dev_' || (vec_id % 4 % 2) AS device, TIMESTAMP '2024-01-01' + to_minutes((vec_id % 500) * 85) AS recorded,
         lpad((vec_id % 4)::VARCHAR, 24, '0') AS sensor_id, CASE WHEN vec_id % 3 = 0 THEN 'VV' ELSE 'AH' END AS wave_code,
         embedding::DOUBLE[] AS y, len(embedding) AS n, (CASE WHEN vec_id % 3 = 0 THEN 300.0 ELSE 50000.0 END)::DOUBLE AS fs
  FROM embeddings)"""

WAVE_NAME = ("strftime(recorded, '%Y%m%d %H%M%S') || '_' || lpad(lower(to_hex(vec_id)), 24, '0') || '_' || sensor_id || '_' || wave_code || '.json'")

LOCATED = WAVES + """, located AS (
  SELECT *, CASE WHEN vec_id % 4 < 3 THEN 'loc_' || (vec_id % 4) END AS location FROM waves)"""

TIME_METRICS = """, moments AS (
  SELECT vec_id, n, sqrt(list_sum(list_transform(y, lambda v: v * v)) / n) AS rms,
         list_max(list_transform(y, lambda v: abs(v))) AS peak, list_sum(y) / n AS mean, y FROM waves),
time_part AS (
  SELECT vec_id, rms AS velocity_rms, peak / nullif(rms, 0) AS crest_factor,
         (list_sum(list_transform(y, lambda v: pow(v - mean, 4))) / n) /
           nullif(pow(list_sum(list_transform(y, lambda v: pow(v - mean, 2))) / n, 2), 0) AS kurtosis_opt,
         peak AS peak_value_opt FROM moments)"""

BANDS = """, samples AS (
  SELECT vec_id, n, fs, unnest(y) - list_sum(y) / n AS x, unnest(range(n)) AS j FROM waves),
bins AS (
  SELECT vec_id, n, fs, k, sum(x * cos(2 * pi() * (k * j % n) / n)) AS re, -sum(x * sin(2 * pi() * (k * j % n) / n)) AS im
  FROM samples, LATERAL (SELECT unnest(range(n // 2 + 1)) AS k) GROUP BY ALL),
rms_part AS (
  SELECT vec_id,
    sqrt(sum((re * re + im * im) / n) FILTER (k * fs / n BETWEEN 0.1 AND 10)) AS rms_0_10hz,
    sqrt(sum((re * re + im * im) / n) FILTER (k * fs / n BETWEEN 10 AND 100)) AS rms_10_100hz,
    sqrt(sum((re * re + im * im) / n) FILTER (k * fs / n BETWEEN 1000 AND 10000)) AS rms_1_10khz,
    sqrt(sum((re * re + im * im) / n) FILTER (k * fs / n BETWEEN 10000 AND 25000)) AS rms_10_25khz
  FROM bins GROUP BY vec_id),
passed AS (
  SELECT s.vec_id, s.j, coalesce(sum(CASE WHEN 2 * k = s.n THEN 1 ELSE 2 END * (re * cos(2 * pi() * (k * j % s.n) / s.n) - im * sin(2 * pi() * (k * j % s.n) / s.n)) / s.n), 0) AS v
  FROM samples s LEFT JOIN bins b ON b.vec_id = s.vec_id AND k * b.fs / b.n BETWEEN 10 AND 1000 GROUP BY s.vec_id, s.j),
peak_part AS (SELECT vec_id, max(abs(v)) AS peak_10_1000hz FROM passed GROUP BY vec_id)"""

POINTS = """series AS MATERIALIZED (
  SELECT 'dev_' || (user_id % 2) AS device, 'loc_' || (user_id % 4) AS location, ts,
         value - avg(value) OVER g AS x, row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, value) - 1 AS j,
         count(*) OVER g AS n
  FROM events WINDOW g AS (PARTITION BY user_id % 4))"""

TRANSFORM = """,
ks AS (SELECT DISTINCT device, location, n, unnest(range(n)) AS k FROM series),
dft AS MATERIALIZED (
  SELECT device, location, n, k, sum(x * cos(2 * pi() * (k * j % n) / n)) AS re, -sum(x * sin(2 * pi() * (k * j % n) / n)) AS im
  FROM series JOIN ks USING (device, location, n) GROUP BY ALL)"""

ENVELOPE_PART = """, half AS (
  SELECT device, location, n, k, CASE WHEN k = 0 OR 2 * k = n THEN 1 ELSE 2 END AS w, re, im FROM dft WHERE 2 * k <= n),
analytic AS (
  SELECT s.device, s.location, s.ts, s.j, s.n,
         sum(w * (re * cos(2 * pi() * (k * j % s.n) / s.n) - im * sin(2 * pi() * (k * j % s.n) / s.n))) / s.n AS a,
         sum(w * (re * sin(2 * pi() * (k * j % s.n) / s.n) + im * cos(2 * pi() * (k * j % s.n) / s.n))) / s.n AS b
  FROM series s JOIN half h USING (device, location) GROUP BY s.device, s.location, s.ts, s.j, s.n),
env AS MATERIALIZED (
  SELECT device, location, ts, j, n, sqrt(a * a + b * b) - avg(sqrt(a * a + b * b)) OVER (PARTITION BY device, location) AS v FROM analytic)"""

ENV_DFT_PART = """, env_dft AS (
  SELECT e.device, e.location, e.n, k, sum(v * cos(2 * pi() * (k * j % e.n) / e.n)) AS re, -sum(v * sin(2 * pi() * (k * j % e.n) / e.n)) AS im
  FROM env e JOIN ks USING (device, location) WHERE k < e.n // 2 GROUP BY ALL)"""

SERIES = POINTS + TRANSFORM
ENVELOPE = SERIES + ENVELOPE_PART
ENV_DFT = ENVELOPE + ENV_DFT_PART

SPECTRUM_COLUMNS = "device, location, k AS bin, round(k / (n * 5.0) * 1000 + 1e-9, 4) + 0.0 AS frequency, round(sqrt(re * re + im * im) + 1e-9, 4) + 0.0 AS amplitude"

TABLE = """regression AS (
  SELECT *, 7.0::DOUBLE AS steady, floor(epoch(l_shipdate))::DOUBLE AS ship_ts FROM lineitem)"""

FOLDS = TABLE + """, numbered AS (
  SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS row_index,
         count(*) OVER () AS n FROM regression),
folded AS (
  SELECT *, CASE WHEN row_index >= n - 3 * (n // 4) THEN ((row_index - (n - 3 * (n // 4))) // (n // 4))::INTEGER END AS test_fold FROM numbered)"""

SCORES = FOLDS + """, scored AS (
  SELECT test_fold AS fold, u.target, u.model, u.y, u.p
  FROM folded, LATERAL (SELECT unnest([
    {'target': 'price', 'model': 'linear', 'y': l_extendedprice, 'p': l_quantity * 1500},
    {'target': 'price', 'model': 'flat', 'y': l_extendedprice, 'p': 38000.0::DOUBLE},
    {'target': 'steady', 'model': 'linear', 'y': steady, 'p': l_quantity * 1500},
    {'target': 'steady', 'model': 'flat', 'y': steady, 'p': 7.0::DOUBLE}]) AS u) x WHERE test_fold IS NOT NULL),
fold_scores AS (
  SELECT target, model, fold, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
         CASE WHEN min(y) = max(y) THEN CASE WHEN avg((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1 - avg((y - p) * (y - p)) / var_pop(y) END AS r2,
         CASE WHEN min(y) = max(y) THEN CASE WHEN var_pop(y - p) = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1 - var_pop(y - p) / var_pop(y) END AS ev
  FROM scored GROUP BY ALL),
summary AS (
  SELECT target, model, avg(mse) AS mse, avg(sqrt(mse)) AS rmse, avg(mae) AS mae, avg(r2) AS r2, avg(ev) AS ev FROM fold_scores GROUP BY ALL)"""

SCORE_COLUMNS = 'target, model, round(mse + 1e-9, 2) + 0.0 AS "MSE", round(rmse + 1e-9, 2) + 0.0 AS "RMSE", round(mae + 1e-9, 2) + 0.0 AS "MAE", round(r2 + 1e-9, 2) + 0.0 AS "R2", round(ev + 1e-9, 2) + 0.0 AS "Explained Variance"'


def q(members: str, select: str) -> str:
    return f"WITH RECURSIVE {members} {select}"


WIDE_OUT = f'device, datetime, location, {r("click")}, {r("signup")}, {r(chr(34) + "view" + chr(34), "view")}'
RATED_OUT = f'{r("error")}, {r("purchase")}'
VIEW = '"view"'

ORACLES: dict[str, str] = {}

# -- sources and sinks ------------------------------------------------------

ORACLES["scan_readings"] = q(READINGS, 'SELECT id, "Date", "Time", "Measurement", data, device, location FROM readings')
ORACLES["route_files"] = q(READINGS + ", " + RATINGS, """
SELECT 'reading' AS kind, location, "Date", "Time", "Measurement" AS name, data AS value FROM readings WHERE device = 'dev_0'
UNION ALL
SELECT 'rating', NULL, strftime(datetime, '%Y-%m-%d'), strftime(datetime, '%H:%M:%S'), "Metric", "Rating" FROM ratings WHERE device = 'dev_0'""")
ORACLES["union_by_name"] = q(READINGS + ", " + RATINGS, """
SELECT datetime, device, location, "Measurement", data FROM readings UNION ALL BY NAME SELECT device, datetime, "Metric", "Rating" FROM ratings""")
ORACLES["scan_waveform_json"] = q(WAVES, f"""
SELECT strftime(recorded, '%Y%m%d') || '#' || device || '/' || {WAVE_NAME} AS filepath, {WAVE_NAME} AS file_name,
       n::INTEGER AS n_x, n::INTEGER AS n_y, {r("list_sum(y)", "total")} FROM waves WHERE device = 'dev_1'""")
ORACLES["scan_waveform_binary"] = f"""
SELECT vec_id, TIMESTAMP '2024-01-01' + to_minutes(vec_id) AS "timestamp", 50000.0::DOUBLE AS fs, len(embedding)::INTEGER AS n_y,
       {r("list_sum(embedding::DOUBLE[])", "total")} FROM embeddings WHERE vec_id % 10 <> 0"""
ORACLES["scan_waveform_parts"] = f"""
SELECT vec_id, TIMESTAMP '2024-01-01' + to_minutes(vec_id) AS "timestamp", 50000.0::DOUBLE AS fs, len(embedding)::BIGINT AS n_y,
       {r("list_sum(embedding::DOUBLE[])", "total")}, ceil(len(embedding) * 4 / 100.0)::BIGINT AS pieces FROM embeddings WHERE vec_id % 10 <> 0"""
ORACLES["stream_waveforms"] = """
SELECT vec_id, TIMESTAMP '2024-01-01' + to_minutes(vec_id) AS "timestamp", len(embedding)::INTEGER AS n_y, (1 + vec_id % 2)::INTEGER AS run
FROM embeddings WHERE vec_id % 10 <> 0"""
ORACLES["write_stage"] = q(WIDE, f"SELECT {WIDE_OUT} FROM wide")

# -- projections, filters, scalars ------------------------------------------

ORACLES["parse_datetime"] = q(READINGS, """
SELECT id, CASE WHEN id % 50 <> 0 THEN strptime("Date" || ' ' || "Time", '%Y-%m-%d %H:%M:%S') END AS datetime FROM readings""")
ORACLES["filter_range"] = q(READINGS, """
SELECT id, datetime, device, data FROM readings WHERE datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 12:00:00'""")
ORACLES["overlap_range"] = q(WIDE + ", " + RATED + _overlap("wide"), """
SELECT 'reading' AS side, device, datetime FROM left_rows UNION ALL SELECT 'rating', device, datetime FROM right_rows""")
ORACLES["drop_columns"] = q(READINGS, 'SELECT id, "Measurement", data, device, location FROM readings')
ORACLES["suffix_ratings"] = q(RATED, f'SELECT device, datetime, {r("error", "error_rating")}, {r("purchase", "purchase_rating")} FROM rated')
ORACLES["drop_nulls"] = q(RATED, f"SELECT device, datetime, {RATED_OUT} FROM rated WHERE error IS NOT NULL AND purchase IS NOT NULL")
ORACLES["epoch_seconds"] = "SELECT event_id, floor(epoch_us(ts) / 1000000)::BIGINT AS datetime_ts FROM events"
ORACLES["one_hot"] = q(LOCATED, "SELECT vec_id, " + ", ".join(
    [f"coalesce((location = 'loc_{i}')::INTEGER, 0) AS loc_loc_{i}" for i in range(3)]
    + [f"(wave_code = '{c}')::INTEGER AS wave_{c}" for c in ("AH", "VV")]) + " FROM located")
ORACLES["parse_wave_time"] = q(WAVES, 'SELECT vec_id, recorded AS "timestamp" FROM waves WHERE vec_id % 5 <> 1')
ORACLES["parse_wave_name"] = q(WAVES, """
SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN sensor_id END AS sensor_id, CASE WHEN vec_id % 7 <> 0 THEN wave_code END AS wave_code FROM waves""")
ORACLES["map_location"] = q(LOCATED, "SELECT sensor_id, vec_id, location FROM located")
ORACLES["canon_device"] = """
SELECT event_id, CASE user_id % 3 WHEN 0 THEN '1#High-Temp Fan' WHEN 1 THEN '8#Belt Conveyer' ELSE 'Tube Mill' END AS device FROM events"""
ORACLES["display_names"] = """
WITH named AS (SELECT event_id, event_type || ' ' || (user_id % 3) || ' 10khz' AS s FROM events)
SELECT event_id, upper(s) AS heading, array_to_string(list_transform(range(1, length(s) + 1), lambda i:
  CASE WHEN i = 1 OR NOT regexp_matches(substr(s, i - 1, 1), '[a-z]') THEN upper(substr(s, i, 1)) ELSE substr(s, i, 1) END), '') AS label FROM named"""
ORACLES["distinct_locations"] = q(READINGS, "SELECT DISTINCT device, location FROM readings")
ORACLES["location_filter"] = q(READINGS, "SELECT id, device, location, data FROM readings WHERE device = 'dev_0' AND location IN ('loc_2', 'loc_9')")
ORACLES["first_n"] = q(READINGS, "SELECT datetime, id, data FROM readings ORDER BY datetime, id LIMIT 500")
ORACLES["numeric_only"] = q(READINGS, "SELECT id, data, datetime, (data > 100)::INTEGER AS hot FROM readings")
ORACLES["rating_band"] = q(RATINGS, """
, shown AS (SELECT device, datetime, "Metric", nullif("Rating", 40) AS "Rating" FROM ratings)
SELECT *, CASE WHEN "Rating" >= 80 THEN 'healthy' WHEN "Rating" >= 60 THEN 'usable' WHEN "Rating" >= 30 THEN 'warning'
               WHEN "Rating" IS NOT NULL THEN 'fault' END AS band FROM shown""")
ORACLES["sort_time"] = q(READINGS, "SELECT datetime, location, id FROM readings ORDER BY ALL")

# -- reshape and aggregation ------------------------------------------------

ORACLES["pivot_readings"] = q(WIDE, f"SELECT {WIDE_OUT} FROM wide")
ORACLES["pivot_ratings"] = q(RATED, f"SELECT device, datetime, {RATED_OUT} FROM rated")
ORACLES["unpivot_targets"] = q(RATED, f"""
SELECT 'error' AS "Target", {r("error", "Value")} FROM rated UNION ALL SELECT 'purchase', {r("purchase", "Value")} FROM rated""")
ORACLES["bucket_summary"] = q(BUCKETS, "SELECT * FROM summary")


def _profile() -> str:
    def one(c: str, dtype: str, numeric: bool) -> str:
        x = f'"{c}"' if numeric else "NULL::DOUBLE"
        stats = ", ".join(r(f"{f}({x})", n, 5) for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")))
        quart = ", ".join(r(f"quantile_cont({x}, {p / 100})", f"q{p}", 5) for p in (25, 50, 75))
        return f"""SELECT '{c}' AS "column", '{dtype}' AS dtype, count(*) AS n_rows, count(*) - count("{c}") AS n_null, {stats}, {quart}, 6 AS n_columns FROM wide"""
    cols = [("device", "string", False), ("datetime", "timestamp_ntz", False), ("location", "string", False)]
    cols += [(m, "double", True) for m in ("click", "signup", "view")]
    return " UNION ALL ".join(one(*c) for c in cols)


ORACLES["profile"] = q(WIDE, _profile())
ORACLES["radar_means"] = q(RATED, f"""
, binned AS (
  SELECT time_bucket(INTERVAL '15 minutes', datetime) AS b, avg(error) AS error, avg(purchase) AS purchase FROM rated
  WHERE device = 'dev_1' AND datetime BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20' GROUP BY b)
SELECT 'error' AS rating, {r("avg(error)", "mean")} FROM binned UNION ALL SELECT 'purchase', {r("avg(purchase)", "mean")} FROM binned""")


def _histogram(source: str, cols: list[str], keys: list[str]) -> str:
    by = ", ".join([*keys, "feature"])
    long = " UNION ALL ".join(f"""SELECT {''.join(k + ', ' for k in keys)}'{c}' AS feature, "{c}"::DOUBLE AS v FROM {source} WHERE "{c}" IS NOT NULL""" for c in cols)
    return f""", long AS ({long}),
ranges AS (SELECT {by}, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                  CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM long GROUP BY {by}),
counted AS (SELECT {by}, least(floor((v - lo) * 30 / (hi - lo))::INTEGER + 1, 30) AS bin, count(*) AS n FROM long JOIN ranges USING ({by}) GROUP BY ALL),
grid AS (SELECT *, unnest(range(1, 31))::INTEGER AS bin FROM ranges)
SELECT {by}, bin, {r("lo + (hi - lo) * (bin - 1) / 30", "bin_start")}, {r("lo + (hi - lo) * bin / 30", "bin_end")}, coalesce(n, 0) AS n
FROM grid LEFT JOIN counted USING ({by}, bin)"""


ORACLES["histogram_by_location"] = q(WIDE, _histogram("wide", ["click", "signup", "view"], ["device", "location"]))
ORACLES["histogram_targets"] = q(RATED, _histogram("(SELECT *, 5.0::DOUBLE AS steady FROM rated)", ["error", "purchase", "steady"], []))
ORACLES["box_stats"] = q(WIDE, f""", long AS (
  SELECT location, 'click' AS feature, click AS v FROM wide UNION ALL SELECT location, 'signup', signup FROM wide
  UNION ALL SELECT location, 'view', "view" FROM wide),
quart AS (SELECT location, feature, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
          FROM long WHERE v IS NOT NULL GROUP BY ALL),
joined AS (SELECT *, v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM long JOIN quart USING (location, feature) WHERE v IS NOT NULL)
SELECT location, feature, n, {r("q1")}, {r("median")}, {r("q3")},
       {r("least(min(v) FILTER (inside), q1)", "whisker_low")}, {r("greatest(max(v) FILTER (inside), q3)", "whisker_high")},
       count(*) FILTER (NOT inside) AS n_outliers FROM joined GROUP BY location, feature, n, q1, median, q3""")

FEATURES = ["l_quantity", "l_discount", "l_tax", "ship_ts"]


def _corr(x: str, y: str) -> str:
    return f"covar_samp({x}, {y}) / nullif(stddev_samp(CASE WHEN {y} IS NOT NULL THEN {x} END) * stddev_samp(CASE WHEN {x} IS NOT NULL THEN {y} END), 0)"


ORACLES["corr_matrix"] = q(TABLE, " UNION ALL ".join(
    f"""SELECT '{x}' AS x, '{y}' AS y, {r(_corr(x, y), "corr", 5)} FROM regression"""
    for x in [*FEATURES, "l_extendedprice", "steady"] for y in [*FEATURES, "l_extendedprice", "steady"]))
ORACLES["corr_cross"] = q(TABLE, " UNION ALL ".join(
    f"""SELECT '{x}' AS feature, '{y}' AS target, {r(_corr(x, y), "corr", 5)} FROM regression"""
    for x in FEATURES for y in ("l_extendedprice", "steady")))


ORACLES["iqr_filter"] = q(READINGS, """, bounds AS (SELECT quantile_cont(data, 0.25) AS q1, quantile_cont(data, 0.75) AS q3 FROM readings)
SELECT id, data FROM readings, bounds WHERE data BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
ORACLES["subsample"] = q(READINGS, "SELECT id, data FROM readings WHERE ('0x' || substr(md5(id || '|42'), 1, 8))::BIGINT % 100 < 30")
ORACLES["pair_points"] = q(TABLE, " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS feature, {c} AS x, 'l_extendedprice' AS target, l_extendedprice AS y FROM regression" for c in ("l_quantity", "l_tax")))
ORACLES["time_extent"] = q(READINGS, 'SELECT device, min(datetime) AS "start", max(datetime) AS "end" FROM readings GROUP BY device')

# -- time series ------------------------------------------------------------

ORACLES["forward_fill"] = q(FILLED, f"SELECT {WIDE_OUT} FROM filled")
ORACLES["bucket_assign"] = q(MARKED, "SELECT device, location, datetime, bucket_id, anchor AS bucket_start FROM marked")
BINNED = WIDE + f""", binned AS (
  SELECT location, device, time_bucket(INTERVAL '15 minutes', datetime) AS datetime, avg(click) AS click, avg(signup) AS signup, avg("view") AS "view"
  FROM wide WHERE datetime BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}' GROUP BY ALL)"""
ORACLES["resample_adaptive"] = q(BINNED, f"SELECT {WIDE_OUT} FROM binned")
ORACLES["resample_gapfill"] = q(BINNED, f""", grid AS (
  SELECT location, device, unnest(generate_series(lo, hi, INTERVAL '15 minutes')) AS datetime
  FROM (SELECT location, device, min(datetime) AS lo, max(datetime) AS hi FROM binned GROUP BY location, device))
SELECT {WIDE_OUT} FROM grid LEFT JOIN binned USING (location, device, datetime)""")
ORACLES["dashboard_selection"] = ORACLES["resample_gapfill"] + " WHERE device = 'dev_1' AND location = 'loc_1'"
ORACLES["dashboard_signal"] = q(BINNED + """, series AS MATERIALIZED (
  SELECT device, location, datetime AS ts, "view" - avg("view") OVER g AS x, row_number() OVER (PARTITION BY location ORDER BY datetime) - 1 AS j,
         count(*) OVER g AS n
  FROM binned WHERE device = 'dev_1' AND "view" IS NOT NULL WINDOW g AS (PARTITION BY location))""" + TRANSFORM + ENVELOPE_PART + ENV_DFT_PART, f"""
SELECT device, location, 'raw' AS panel, ts AS datetime, NULL::BIGINT AS bin, NULL::DOUBLE AS x, {r("x", "y", 4)} FROM series
UNION ALL SELECT device, location, 'envelope', ts, NULL, NULL, {r("v", "y", 4)} FROM env
UNION ALL SELECT device, location, 'spectrum', NULL, k, {r("k / (n * 900.0) * 1000000", "x", 4)}, {r("sqrt(re * re + im * im)", "y", 4)} FROM dft WHERE k < n // 2
UNION ALL SELECT device, location, 'envelope_spectrum', NULL, k, {r("k / (n * 900.0) * 1000000", "x", 4)}, {r("sqrt(re * re + im * im)", "y", 4)} FROM env_dft""")
ORACLES["overlay_series"] = q(WIDE, f"""
SELECT device, location, datetime, 'click' AS series, {r("click", "value")} FROM wide
UNION ALL SELECT device, location, datetime, 'view', {r(VIEW, "value")} FROM wide""")
ORACLES["sequence_windows"] = q(WIDE, f""", stepped AS (
  SELECT device, location, time_bucket(INTERVAL '120 minutes', datetime) AS bucket_start,
         floor((epoch_us(datetime) - epoch_us(time_bucket(INTERVAL '120 minutes', datetime))) / 30000000)::INTEGER AS step,
         avg(click) AS click, avg("view") AS "view" FROM wide GROUP BY ALL),
grid AS (
  SELECT device, location, bucket_start, unnest(range(last + 1))::INTEGER AS step
  FROM (SELECT device, location, bucket_start, max(step) AS last FROM stepped GROUP BY device, location, bucket_start)),
steps AS (
  SELECT device, location, bucket_start, step,
         coalesce(last_value(click IGNORE NULLS) OVER w, 0) AS click, coalesce(last_value("view" IGNORE NULLS) OVER w, 0) AS "view"
  FROM grid LEFT JOIN stepped USING (device, location, bucket_start, step)
  WINDOW w AS (PARTITION BY device, location, bucket_start ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT device, location, bucket_start, count(*)::INTEGER AS n_steps, 240 AS "length",
       {r("sum(click)", "click_sum", 4)}, {r("sum(click * (step + 1))", "click_weighted", 4)},
       {r('sum("view")', "view_sum", 4)}, {r('sum("view" * (step + 1))', "view_weighted", 4)}
FROM steps GROUP BY device, location, bucket_start""")

# -- joins ------------------------------------------------------------------

MERGED_OUT = f"{WIDE_OUT}, {RATED_OUT}"
for name, sign in (("asof_forward", "<="), ("asof_backward", ">=")):
    ORACLES[name] = q(WIDE + ", " + RATED, f"""
, joined AS (SELECT l.*, r.error, r.purchase FROM wide l ASOF LEFT JOIN rated r ON l.device = r.device AND l.datetime {sign} r.datetime)
SELECT {MERGED_OUT} FROM joined""")
ORACLES["merged_table"] = q(MERGED, f"SELECT {MERGED_OUT} FROM merged")
CONTAINED = """
SELECT vec_id, device, location, w.recorded AS "timestamp", bucket_id, bucket_start, bucket_end
FROM located w JOIN summary s USING (device, location) WHERE w.recorded BETWEEN bucket_start AND bucket_end"""
ORACLES["interval_join"] = q(BUCKETS + ", " + LOCATED, CONTAINED)
ORACLES["interval_join_binned"] = ORACLES["interval_join"]

# -- waveforms and spectra --------------------------------------------------

WAVE_PART = ", ".join(r(c, c, 4) for c in (
    "velocity_rms", "crest_factor", "kurtosis_opt", "peak_value_opt", "rms_0_10hz", "rms_10_100hz", "rms_1_10khz", "rms_10_25khz", "peak_10_1000hz"))
WAVE_JOINS = "located JOIN time_part USING (vec_id) JOIN rms_part USING (vec_id) JOIN peak_part USING (vec_id)"
ORACLES["feature_table"] = q(BUCKETS + ", " + LOCATED + TIME_METRICS + BANDS, f"""
SELECT recorded AS "timestamp", {WAVE_PART}, sensor_id, wave_code, device, location, bucket_id, {r("view_mean", "view_mean", 4)}, view_count,
       {r("error_rating", "error_rating", 4)}, bucket_start, bucket_end
FROM {WAVE_JOINS} JOIN summary s USING (device, location) WHERE recorded BETWEEN bucket_start AND bucket_end""")
ORACLES["sampling_rate"] = q(WAVES, f"SELECT vec_id, {r('(CASE WHEN vec_id % 10 >= 2 THEN fs END)', 'fs')} FROM waves")
ORACLES["time_metrics"] = q(WAVES + TIME_METRICS, f"SELECT vec_id, {', '.join(r(c) for c in ('velocity_rms', 'crest_factor', 'kurtosis_opt', 'peak_value_opt'))} FROM time_part")
ORACLES["band_rms"] = q(WAVES + BANDS, f"SELECT vec_id, {', '.join(r(c, c, 4) for c in ('rms_0_10hz', 'rms_10_100hz', 'rms_1_10khz', 'rms_10_25khz'))} FROM rms_part")
ORACLES["band_peak"] = q(WAVES + BANDS, f"SELECT vec_id, {r('peak_10_1000hz', 'peak_10_1000hz', 4)} FROM peak_part")
ORACLES["waveform_metrics"] = q(LOCATED + TIME_METRICS + BANDS, f"""
SELECT device, recorded AS "timestamp", {WAVE_PART}, sensor_id, wave_code, location FROM {WAVE_JOINS}""")
ORACLES["spectrum"] = q(SERIES, f"SELECT {SPECTRUM_COLUMNS} FROM dft WHERE k < n // 2")
ORACLES["envelope"] = q(ENVELOPE, f'SELECT device, location, ts AS "timestamp", {r("v", "envelope", 4)} FROM env')
ORACLES["envelope_spectrum"] = q(ENV_DFT, f"SELECT {SPECTRUM_COLUMNS} FROM env_dft")
ORACLES["signal_panels"] = q(ENV_DFT, f"""
SELECT device, location, 'raw' AS panel, ts AS "timestamp", NULL::BIGINT AS bin, NULL::DOUBLE AS x, {r("x", "y", 4)} FROM series
UNION ALL SELECT device, location, 'envelope', ts, NULL, NULL, {r("v", "y", 4)} FROM env
UNION ALL SELECT device, location, 'spectrum', NULL, bin, frequency, amplitude FROM (SELECT {SPECTRUM_COLUMNS} FROM dft WHERE k < n // 2)
UNION ALL SELECT device, location, 'envelope_spectrum', NULL, bin, frequency, amplitude FROM (SELECT {SPECTRUM_COLUMNS} FROM env_dft)""")

# -- modelling --------------------------------------------------------------

ORACLES["standardise"] = q(TABLE, f""", s AS (
  SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd FROM regression WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_orderkey, l_linenumber, {r("(l_quantity - mq) / sq", "l_quantity")}, {r("(l_discount - md) / sd", "l_discount")}, {r("steady - 7", "steady")} FROM regression, s""")
ORACLES["poly_features"] = q(TABLE, f"""
SELECT l_orderkey, l_linenumber, {r("l_quantity", "q")}, {r("l_quantity * l_quantity", "q2")}, {r("l_discount", "d")},
       {r("l_quantity * l_discount", "qd")}, {r("l_discount * l_discount", "d2")} FROM regression""")
ORACLES["time_folds"] = q(FOLDS, "SELECT l_orderkey, l_linenumber, row_index, test_fold FROM folded")
ORACLES["baseline_mean"] = q(FOLDS, " UNION ALL ".join(
    f"SELECT {i}::INTEGER AS fold, {r('avg(l_extendedprice)', 'prediction', 4)} FROM folded WHERE test_fold IS NULL OR test_fold < {i}" for i in range(3)))
ORACLES["fold_metrics"] = q(SCORES, 'SELECT target, model, fold, round(mse + 1e-9, 2) + 0.0 AS "MSE", round(mae + 1e-9, 2) + 0.0 AS "MAE", round(r2 + 1e-9, 2) + 0.0 AS "R2", round(ev + 1e-9, 2) + 0.0 AS "Explained Variance" FROM fold_scores')
ORACLES["cv_summary"] = q(SCORES, f"SELECT {SCORE_COLUMNS} FROM summary")
ORACLES["select_best"] = q(SCORES, f"""
SELECT {SCORE_COLUMNS} FROM summary QUALIFY row_number() OVER (PARTITION BY target ORDER BY r2 DESC, list_position(['linear', 'flat'], model)) = 1""")
ORACLES["ridge"] = q(TABLE, """, s AS (
  SELECT count(*) AS n, corr(l_quantity, l_discount) AS rho, covar_pop(l_quantity, l_extendedprice) / stddev_pop(l_quantity) AS b1,
         covar_pop(l_discount, l_extendedprice) / stddev_pop(l_discount) AS b2, avg(l_extendedprice) AS mean FROM regression),
w AS (SELECT mean, (b1 * (1 + 1000.0 / n) - rho * b2) / (pow(1 + 1000.0 / n, 2) - rho * rho) AS w1,
             (b2 * (1 + 1000.0 / n) - rho * b1) / (pow(1 + 1000.0 / n, 2) - rho * rho) AS w2 FROM s)
SELECT 'l_quantity' AS term, round(w1 + 1e-9, 2) + 0.0 AS weight FROM w UNION ALL SELECT 'l_discount', round(w2 + 1e-9, 2) + 0.0 FROM w
UNION ALL SELECT 'intercept', round(mean + 1e-9, 2) + 0.0 FROM w""")

ORACLES["read_stage"] = q(WIDE, f"""SELECT device, datetime AS "timestamp", location, {r("click")}, {r("signup")}, {r('"view"', "view")} FROM wide""")
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_KEY = f"md5(concat_ws('|', {_KEYS}))"
ORACLES["pair_points_bounded"] = f"""
WITH chosen AS (SELECT * FROM lineitem ORDER BY {_KEY} LIMIT 700)
SELECT {_KEYS}, 'l_quantity' AS feature, l_quantity::DOUBLE AS x, 'l_extendedprice' AS target, l_extendedprice::DOUBLE AS y FROM chosen
UNION ALL SELECT {_KEYS}, 'l_tax', l_tax::DOUBLE, 'l_extendedprice', l_extendedprice::DOUBLE FROM chosen"""
_PROBS = ["0.0", "0.25", "0.5", "0.75", "0.999"]
_COLUMNS = {"l_quantity": "l_quantity", "l_discount": "l_discount", "l_tax": "l_tax", "ship_ts": "floor(epoch(l_shipdate))",
            "l_extendedprice": "l_extendedprice", "steady": "7.0"}
ORACLES["selected_quantiles"] = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, count({x}) AS n, {i}::INTEGER AS place, {r(f'quantile_cont(({x})::DOUBLE, {p})', 'value', 5)} FROM lineitem"
    for name, x in _COLUMNS.items() for i, p in enumerate(_PROBS))
ORACLES["sketched_profile"] = q(READINGS, """
SELECT "Measurement", count(*) AS n, asked::DOUBLE AS asked, true AS within FROM readings, (VALUES (0.25), (0.5), (0.75)) v(asked)
WHERE "Measurement" IN ('click', 'signup', 'view') GROUP BY ALL""")
ORACLES["iqr_filter_selected"] = ORACLES["iqr_filter"]

# -- streaming --------------------------------------------------------------

ORACLES["stream_ingest"] = q(READINGS, "SELECT device, count(*) AS n_rows, max(datetime) AS last_reading FROM readings GROUP BY device")
ORACLES["stream_resample"] = q(READINGS, f"""
, binned AS (SELECT location, device, time_bucket(INTERVAL '15 minutes', datetime) AS b, avg(data) AS mean_data FROM readings GROUP BY ALL)
SELECT location, device, b AS datetime, {r("mean_data")} FROM binned""")
ORACLES["stream_resample_live"] = q(READINGS, f"""
, binned AS (SELECT location, device, time_bucket(INTERVAL '15 minutes', datetime) AS b, avg(data) AS mean_data FROM readings GROUP BY ALL)
SELECT location, device, b AS datetime, {r("mean_data")} FROM binned
WHERE b + INTERVAL '15 minutes' <= (SELECT max(datetime) FROM readings) - INTERVAL '1 hour'""")
ORACLES["stream_dedup"] = q(READINGS, "SELECT id, datetime, device, data FROM readings")
ORACLES["stream_dedup_live"] = ORACLES["stream_dedup"]
ORACLES["stream_buckets"] = q("""numbered AS MATERIALIZED (
  SELECT 'dev_' || (user_id % 2) AS device, 'loc_' || (user_id % 4) AS location, ts, value AS data, floor(value / 60) * 20 AS level,
         row_number() OVER w AS rn, lag(floor(value / 60)) OVER w IS DISTINCT FROM floor(value / 60) AS changed
  FROM events WINDOW w AS (PARTITION BY user_id % 4 ORDER BY ts)),
walk AS (
  SELECT device, location, rn, ts AS opened, 1 AS bucket FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.device, n.location, n.rn,
         CASE WHEN n.changed OR n.ts >= w.opened + INTERVAL '120 minutes' THEN n.ts ELSE w.opened END,
         w.bucket + CASE WHEN n.changed OR n.ts >= w.opened + INTERVAL '120 minutes' THEN 1 ELSE 0 END
  FROM walk w JOIN numbered n ON n.location = w.location AND n.rn = w.rn + 1),
grouped AS (
  SELECT device, location, bucket, count(data) AS n, avg(data) AS mean, stddev_samp(data) AS std, min(data) AS lo, max(data) AS hi,
         min(level) AS level, min(ts) AS bucket_start, max(ts) AS bucket_end
  FROM numbered JOIN walk USING (device, location, rn) GROUP BY device, location, bucket)""", f"""
SELECT device, location, n AS data_count, {r("mean", "data_mean")}, {r("std", "data_std")}, {r("lo", "data_min")}, {r("hi", "data_max")},
       {r("level")}, bucket_start, bucket_end
FROM grouped""")

# -- the same results by the ways that large inputs take ----------------------

for small, large in (("box_stats", "box_stats_ranked"), ("profile", "profile_ranked"), ("asof_forward", "asof_shuffled"),
                     ("bucket_assign", "bucket_assign_shuffled"), ("stream_buckets", "stream_buckets_live"), ("spectrum", "spectrum_spread"), ("signal_panels", "signal_panels_spread")):
    ORACLES[large] = ORACLES[small]
_MODEL_ROWS = f"""{WAVE_JOINS} JOIN summary s USING (device, location)
WHERE recorded BETWEEN bucket_start AND bucket_end AND rms_1_10khz IS NOT NULL AND rms_10_25khz IS NOT NULL AND view_mean IS NOT NULL
  AND error_rating IS NOT NULL AND velocity_rms IS NOT NULL"""
ORACLES["regression_table"] = q(BUCKETS + ", " + LOCATED + TIME_METRICS + BANDS, f"""
SELECT recorded AS "timestamp", epoch(recorded)::BIGINT AS datetime_ts, {r("velocity_rms", "velocity_rms", 4)}, {r("rms_1_10khz", "rms_1_10khz", 4)},
       {r("rms_10_25khz", "rms_10_25khz", 4)}, view_count, {r("view_mean", "view_mean", 4)}, {r("error_rating", "error_rating", 4)},
       (location = 'loc_0')::INTEGER AS loc_loc_0, (location = 'loc_1')::INTEGER AS loc_loc_1, (location = 'loc_2')::INTEGER AS loc_loc_2,
       (wave_code = 'AH')::INTEGER AS wave_AH, (wave_code = 'VV')::INTEGER AS wave_VV
FROM {_MODEL_ROWS}""")
ORACLES["train_features"] = q(BUCKETS + ", " + LOCATED + TIME_METRICS + BANDS + f""",
feat AS (SELECT error_rating AS y, row_number() OVER (ORDER BY recorded, velocity_rms) - 1 AS i, count(*) OVER () AS n FROM {_MODEL_ROWS}),
placed AS (SELECT y, i, n, CASE WHEN i >= n - 3 * (n // 4) THEN (i - (n - 3 * (n // 4))) // (n // 4) END AS fold FROM feat),
guess AS (SELECT f AS fold, avg(y) AS p FROM placed, (SELECT unnest(range(3)) AS f) WHERE fold IS NULL OR fold < f GROUP BY f),
by_fold AS (SELECT avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
  CASE WHEN min(y) = max(y) THEN (avg((y - p) * (y - p)) = 0)::INTEGER ELSE 1 - avg((y - p) * (y - p)) / var_pop(y) END AS r2,
  CASE WHEN min(y) = max(y) THEN (var_pop(y - p) = 0)::INTEGER ELSE 1 - var_pop(y - p) / var_pop(y) END AS ev
  FROM placed JOIN guess USING (fold) GROUP BY fold)""", f"""
SELECT 'error_rating' AS target, 'Baseline' AS model, {r("avg(mse)", "MSE", 4)}, {r("avg(sqrt(mse))", "RMSE", 4)}, {r("avg(mae)", "MAE", 4)},
       {r("avg(r2)", "R2", 4)}, {r("avg(ev)", "Explained Variance", 4)}, (SELECT count(*) FROM feat) AS n_predictions, 1 AS n_targets
FROM by_fold""")

# -- models with a closed form ------------------------------------------------


def _ridge_scores(target: str, models: str) -> str:
    """Fold scores of ridge on l_quantity for each (model, alpha); a null alpha is the mean alone."""
    return FOLDS + f""", models AS ({models}),
tr AS (SELECT i, l_quantity AS x, {target} AS y FROM folded, (SELECT unnest(range(3))::INTEGER AS i) WHERE test_fold IS NULL OR test_fold < i),
st AS (SELECT i, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) AS cxy, count(*) AS n FROM tr GROUP BY i),
w AS (SELECT i, model, mx, my, CASE WHEN alpha IS NULL THEN 0 ELSE n * cxy / sx / (n + alpha) / sx END AS b FROM st, models),
p AS (SELECT model, i AS fold, {target} AS y, my + b * (l_quantity - mx) AS p FROM folded JOIN w ON test_fold = i),
by_fold AS (
  SELECT model, fold, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2,
         1 - var_pop(y - p) / var_pop(y) AS ev FROM p GROUP BY model, fold),
mean_scores AS (
  SELECT model, avg(mse) AS mse, avg(sqrt(mse)) AS rmse, avg(mae) AS mae, avg(r2) AS r2, avg(ev) AS ev FROM by_fold GROUP BY model)"""


def _whole(*, means: bool) -> str:
    rmse = 'round(rmse)::BIGINT AS "RMSE", ' if means else ""
    return (f'round(mse)::BIGINT AS "MSE", {rmse}round(mae)::BIGINT AS "MAE", round(r2 + 1e-9, 6) + 0.0 AS "R2", '
            'round(ev + 1e-9, 6) + 0.0 AS "Explained Variance"')


_DRAWS = draw_params("Ridge")
ORACLES["random_search"] = q(_ridge_scores("l_extendedprice", " UNION ALL ".join(
    f"SELECT '{i:02d}' AS model, {p['alpha']!r}::DOUBLE AS alpha" for i, p in enumerate(_DRAWS))), f"""
SELECT 'l_extendedprice' AS target, model, {_whole(means=True)},
       round((SELECT arg_max(alpha, r2) FROM mean_scores JOIN models USING (model)), 6) AS best_alpha FROM mean_scores""")
ORACLES["save_best"] = q(_ridge_scores("l_extendedprice", "SELECT 'Baseline' AS model, NULL::DOUBLE AS alpha UNION ALL SELECT 'Ridge', 1.0"), f"""
SELECT * FROM (SELECT 'l_extendedprice' AS target, model, {_whole(means=True)}, 'dev_0' AS device, (SELECT count(*) FROM folded) AS n_predictions
  FROM mean_scores QUALIFY row_number() OVER (ORDER BY r2 DESC, model) = 1)
UNION ALL SELECT 'steady', 'Baseline', 0, 0, 0, 1.0, 1.0, 'dev_0', count(*) FROM folded""")
ORACLES["poly_ridge"] = q(FOLDS + """,
tr AS (SELECT i, l_quantity AS x, l_extendedprice AS y FROM folded, (SELECT unnest(range(3))::INTEGER AS i) WHERE test_fold IS NULL OR test_fold < i),
st AS (SELECT i, avg(x) AS mx, stddev_pop(x) AS sx FROM tr GROUP BY i),
z AS (SELECT i, (x - mx) / sx AS a, pow((x - mx) / sx, 2) AS b, y FROM tr JOIN st USING (i)),
c AS (SELECT i, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, count(*) * var_pop(a) + 1 AS saa, count(*) * var_pop(b) + 1 AS sbb,
             count(*) * covar_pop(a, b) AS sab, count(*) * covar_pop(a, y) AS say, count(*) * covar_pop(b, y) AS sby FROM z GROUP BY i),
w AS (SELECT *, (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS wa, (saa * sby - sab * say) / (saa * sbb - sab * sab) AS wb FROM c JOIN st USING (i)),
p AS (SELECT i AS fold, l_extendedprice AS y, my + wa * ((l_quantity - mx) / sx - ma) + wb * (pow((l_quantity - mx) / sx, 2) - mb) AS p
      FROM folded JOIN w ON test_fold = i),
by_fold AS (
  SELECT fold, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2,
         1 - var_pop(y - p) / var_pop(y) AS ev FROM p GROUP BY fold)""", f"""
SELECT 'l_extendedprice' AS target, 'PolyRidgeDegree2' AS model, fold, {_whole(means=False)} FROM by_fold""")
ORACLES["model_facts"] = q(FOLDS, """
SELECT DISTINCT 'made' AS target, model, test_fold AS fold, true AS explains, true AS errs
FROM folded, (SELECT unnest(['RandomForest', 'GradientBoosting', 'KernelRidge', 'RuleTree']) AS model) WHERE test_fold IS NOT NULL""")
ORACLES["forest_search"] = """
SELECT 'made' AS target, searched, draw, true AS explains, true AS settled
FROM (SELECT unnest(['RandomForest', 'GradientBoosting']) AS searched), (SELECT unnest(['00', '01']) AS draw)
WHERE EXISTS (SELECT 1 FROM lineitem)"""
