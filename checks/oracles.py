"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

KEY = "date, store_id, product_id"
W = "PARTITION BY store_id, product_id ORDER BY date"

PANEL = """panel AS (
  SELECT CAST(l_shipdate AS DATE) AS date, r_name AS store_id, p_brand AS product_id,
    SUM(l_quantity) AS units_sold,
    CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * SUM(l_quantity)) AS price,
    CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * COUNT(*)) AS discount,
    CAST(SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * COUNT(*)) AS competitor_price,
    CAST(SUM(p_size) AS DOUBLE) AS inventory_level,
    CASE WHEN SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) >= 5 * COUNT(*) THEN 'yes' ELSE 'no' END AS promotion,
    CASE MAX(l_returnflag) WHEN 'R' THEN 'true' WHEN 'N' THEN 'false' END AS holiday,
    MAX(l_linestatus) AS weather,
    SUM(l_quantity) + CAST(SUM(p_size) AS DOUBLE) AS demand_forecast
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3)"""

CUTOFFS = """days AS (SELECT day, ROW_NUMBER() OVER (ORDER BY day) - 1 AS i, COUNT(*) OVER () AS n FROM (SELECT DISTINCT date AS day FROM panel)),
first_cut AS (SELECT ANY_VALUE(n) AS n, GREATEST(1, CAST(FLOOR(ANY_VALUE(n) * 0.7::DOUBLE) AS BIGINT)) AS t0, CAST(FLOOR(ANY_VALUE(n) * 0.85::DOUBLE) AS BIGINT) AS v0 FROM days),
second_cut AS (SELECT n, t0, LEAST(GREATEST(t0 + 1, v0), n - 1) AS v FROM first_cut),
cut AS (SELECT n AS distinct_dates, (SELECT day FROM days WHERE i = LEAST(t0, v - 1)) AS validation_start, (SELECT day FROM days WHERE i = v) AS test_start FROM second_cut)"""

TAGGED = """tagged AS (SELECT panel.*, CASE WHEN date < validation_start THEN 'train' WHEN date < test_start THEN 'validation' ELSE 'test' END AS split FROM panel, cut)"""


def r6(expression: str) -> str:
    return f"(ROUND({expression}, 6) + 0.0::DOUBLE)"


MILLIONTHS = "CAST(ROUND(ABS(prediction - actual) / 1e-6::DOUBLE) AS HUGEINT)"
ACTUAL_MILLIONTHS = "CAST(ROUND(ABS(actual) / 1e-6::DOUBLE) AS HUGEINT)"
BILLIONTHS = "CASE WHEN ABS(actual) > 1e-8 THEN CAST(ROUND(ABS(prediction - actual) / ABS(actual) / 1e-9::DOUBLE) AS HUGEINT) END"


def exact_sum(units: str) -> str:
    return f"CAST(SUM({units}) AS DOUBLE)"


def query(*parts: str) -> str:
    """The last part is the SELECT, the others are CTEs."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def lag(column: str, k: int, window: str = W) -> str:
    return f"LAG({column}, {k}) OVER ({window})"


AGGREGATES = {"mean": "AVG({c})", "std": "STDDEV_SAMP({c})", "min": "MIN({c})", "max": "MAX({c})", "median": "QUANTILE_CONT({c}, 0.5)"}


def rolling(column: str, n: int, stat: str, shift: int = 1, need: int | None = None, window: str = W) -> str:
    frame = f"({window} ROWS BETWEEN {n + shift - 1} PRECEDING AND {shift} PRECEDING)"
    body = AGGREGATES[stat].format(c=column)
    return f"CASE WHEN COUNT({column}) OVER {frame} >= {n if need is None else need} THEN {body} OVER {frame} END"


CALENDAR = {
    "day_of_week": "CAST(ISODOW(date) - 1 AS INTEGER)",
    "day_of_month": "CAST(DAY(date) AS INTEGER)",
    "day_of_year": "CAST(DAYOFYEAR(date) AS INTEGER)",
    "week_of_year": "CAST(WEEKOFYEAR(date) AS INTEGER)",
    "month": "CAST(MONTH(date) AS INTEGER)",
    "quarter": "CAST(QUARTER(date) AS INTEGER)",
    "is_weekend": "CAST(ISODOW(date) >= 6 AS INTEGER)",
    "is_month_start": "CAST(DAY(date) = 1 AS INTEGER)",
    "is_month_end": "CAST(date = LAST_DAY(date) AS INTEGER)",
}
DEMAND = {f"units_sold_lag_{k}": lag("units_sold", k) for k in (1, 7, 14, 28)}
for _n, _stats in {7: ("mean", "std", "min", "max"), 14: ("mean", "std"), 28: ("mean", "std")}.items():
    for _s in _stats:
        _sql = rolling("units_sold", _n, _s)
        DEMAND[f"units_sold_roll_{_s}_{_n}"] = r6(_sql) if _s in ("mean", "std") else _sql
_mean7, _mean28 = rolling("price", 7, "mean"), rolling("price", 28, "mean")
PRICE = {
    "price_lag_1": lag("price", 1),
    "price_lag_7": lag("price", 7),
    "price_change_1d": f"price - {lag('price', 1)}",
    "price_change_7d": f"price - {lag('price', 7)}",
    "price_roll_mean_7": r6(_mean7),
    "price_roll_std_7": r6(rolling("price", 7, "std")),
    "price_momentum_7": r6(f"price / ({_mean7})"),
    "price_momentum_28": r6(f"price / ({_mean28})"),
}
WARMUP = (
    "units_sold_lag_28", "units_sold_roll_mean_28", "units_sold_roll_std_28", "price_lag_7", "price_roll_mean_7",
    "price_roll_std_7", "price_momentum_7", "price_momentum_28",
)
INVENTORY = {
    "low_inventory_flag": "CAST(inventory_level <= GREATEST(0.0::DOUBLE, COALESCE("
    + rolling("inventory_level", 28, "median", need=7)
    + ", (SELECT QUANTILE_CONT(inventory_level, 0.5) FROM panel)) * 0.5::DOUBLE) AS INTEGER)",
    "stockout_proxy": "CAST(inventory_level <= 0 AND units_sold <= 0 AS INTEGER)",
}
BINARY = "CASE WHEN LOWER(TRIM({c})) IN ('1', 'true', 't', 'yes', 'y') THEN 1.0::DOUBLE WHEN LOWER(TRIM({c})) IN ('0', 'false', 'f', 'no', 'n') THEN 0.0::DOUBLE END"
EXOGENOUS = {
    "price_vs_competitor_abs": "price - competitor_price",
    "price_vs_competitor_pct": "CASE WHEN competitor_price > 0 THEN (price - competitor_price) / competitor_price END",
    "promotion": BINARY.format(c="promotion"),
    "holiday": BINARY.format(c="holiday"),
}
WEATHER = "CAST(DENSE_RANK() OVER (ORDER BY COALESCE(LOWER(TRIM(weather)), 'missing')) - 1 AS DOUBLE)"


def columns(named: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in named.items())


def from_panel(*named: dict[str, str] | str) -> str:
    listed = ", ".join(n if isinstance(n, str) else columns(n) for n in named)
    return query(PANEL, f"SELECT {KEY}, {listed} FROM panel")


MANUAL = f"""features AS (SELECT {KEY}, units_sold, price, {columns(CALENDAR)}, {columns(DEMAND)}, {columns(PRICE)},
  discount, demand_forecast, inventory_level, {columns(INVENTORY)}, competitor_price, {columns(EXOGENOUS)}, {WEATHER} AS weather_code FROM panel),
kept AS (SELECT * FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in WARMUP)})"""

RAW = """once AS (
  SELECT STRFTIME(l_shipdate, '%Y-%m-%d') AS day, ' B' || l_suppkey AS branch, l_partkey || ' ' AS sku,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
    CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS price,
    CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'N' THEN ' no ' ELSE 'maybe' END AS promo,
    CASE WHEN l_linestatus = 'O' THEN CAST(CAST(ROUND(l_discount * 100) AS BIGINT) AS VARCHAR) ELSE 'n/a' END AS discount,
    l_linestatus AS weather, l_returnflag, l_linenumber, l_discount, l_tax
  FROM lineitem),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE l_returnflag = 'R')"""
TYPED = f"""typed AS (SELECT CAST(day AS DATE) AS date, TRIM(branch) AS store_id, TRIM(sku) AS product_id,
  CAST(quantity AS DOUBLE) AS units_sold, CAST(price AS DOUBLE) AS price,
  CASE WHEN LOWER(TRIM(promo)) IN ('yes') THEN TRUE WHEN LOWER(TRIM(promo)) IN ('no') THEN FALSE END AS promotion,
  TRY_CAST(discount AS DOUBLE) AS discount, weather FROM raw)"""

FORECASTS = {
    "naive_last": lag("units_sold", 1),
    "seasonal_naive_7": f"COALESCE({lag('units_sold', 7)}, {lag('units_sold', 1)})",
    "rolling_mean_7": f"AVG(units_sold) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)",
    "rolling_mean_28": f"AVG(units_sold) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)",
    "median_expanding": f"QUANTILE_CONT(units_sold, 0.5) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
}
_fallback = """CASE split WHEN 'validation' THEN (SELECT QUANTILE_CONT(units_sold, 0.5) FROM tagged WHERE split = 'train')
  ELSE (SELECT QUANTILE_CONT(units_sold, 0.5) FROM tagged WHERE split IN ('train', 'validation')) END"""


def suite(*names: str) -> str:
    wide = f"wide AS (SELECT *, {', '.join(f'{FORECASTS[n]} AS {n}' for n in names)} FROM tagged)"
    arms = " UNION ALL ".join(
        f"SELECT {KEY}, split, units_sold AS actual, '{n}' AS model_name, {r6(f'COALESCE({n}, {_fallback})')} AS prediction, 'baseline' AS model_family"
        f" FROM wide WHERE split <> 'train'"
        for n in names
    )
    return f"{wide}, suite AS ({arms})"


SUITE = (PANEL, CUTOFFS, TAGGED, suite(*FORECASTS))
PREDICTED = (
    *SUITE,
    "predicted AS (SELECT *, prediction - actual AS prediction_error, ABS(prediction - actual) AS prediction_abs_error FROM suite)",
)
METRICS = {
    "mape": f"{exact_sum(BILLIONTHS)} / COUNT({BILLIONTHS}) / 1e9::DOUBLE * 100",
    "wmape": f"CASE WHEN {exact_sum(ACTUAL_MILLIONTHS)} > 1e-2 THEN {exact_sum(MILLIONTHS)} / {exact_sum(ACTUAL_MILLIONTHS)} ELSE {exact_sum(MILLIONTHS)} / COUNT(*) / 1e6::DOUBLE END * 100",
    "mae": f"{exact_sum(MILLIONTHS)} / COUNT(*) / 1e6::DOUBLE",
    "rmse": r6(f"SQRT({exact_sum(f'{MILLIONTHS} * {MILLIONTHS}')} / COUNT(*)) / 1e6::DOUBLE"),
}
MEASURED = f"measured AS (SELECT split, model_name, model_family, COUNT(*) AS n_obs, {columns(METRICS)} FROM predicted GROUP BY 1, 2, 3)"
SEGMENTED = f"segmented AS (SELECT split, model_name, model_family, 'product_id=' || product_id AS segment_key, COUNT(*) AS n_obs, {columns(METRICS)} FROM predicted GROUP BY 1, 2, 3, 4)"


# The feature table in place of the panel.
FRAMED = (CUTOFFS.replace("FROM panel", "FROM kept"), TAGGED.replace("panel.*", "kept.*").replace("FROM panel", "FROM kept"))
_predicted = "predicted AS (SELECT *, prediction - actual AS prediction_error, ABS(prediction - actual) AS prediction_abs_error FROM suite)"
FRAMED_SUITE = (PANEL, MANUAL, *FRAMED, suite(*FORECASTS), _predicted)


def judged_model(name: str) -> str:
    """The rows that a model is to forecast, and the naive forecast that it is to beat."""
    naive = "naive AS (SELECT split, wmape FROM measured WHERE model_name = 'naive_last')"
    return query(PANEL, MANUAL, *FRAMED, suite("naive_last"), _predicted, MEASURED, naive, f"SELECT {KEY}, split, units_sold AS actual, '{name}' AS model_name, TRUE AS has_prediction, naive.wmape AS naive_wmape, TRUE AS beats_naive FROM tagged JOIN naive USING (split)")


def prefixed(prefix: str, table: str = "") -> str:
    return ", ".join(f"{table}{m} AS {prefix}_{m}" for m in METRICS)


def histogram(source: str, column: str, bins: int) -> tuple[str, str]:
    """CTEs and SELECT of a histogram over one column of `source`."""
    ctes = f"""limits AS (SELECT CASE WHEN MIN(x) = MAX(x) THEN MIN(x) - 0.5::DOUBLE ELSE MIN(x) END AS lo, CASE WHEN MIN(x) = MAX(x) THEN MAX(x) + 0.5::DOUBLE ELSE MAX(x) END AS hi FROM (SELECT {column} AS x FROM {source})),
binned AS (SELECT LEAST({bins - 1}, CAST(FLOOR(({column} - lo) / ((hi - lo) / {bins}.0::DOUBLE)) AS INTEGER)) AS bin, COUNT(*) AS n FROM {source}, limits WHERE {column} IS NOT NULL GROUP BY 1),
bins AS (SELECT CAST(bin AS INTEGER) AS bin, lo, (hi - lo) / {bins}.0::DOUBLE AS width FROM limits, RANGE({bins}) r(bin) WHERE lo IS NOT NULL)"""
    return ctes, f"""SELECT bins.bin, {r6('lo + bins.bin * width')} AS lower_edge, {r6('lo + (bins.bin + 1) * width')} AS upper_edge, COALESCE(n, 0) AS n FROM bins LEFT JOIN binned ON bins.bin = binned.bin"""


LOGLOG = """fits AS (SELECT store_id, product_id, COUNT(*) AS n_observations, MIN(price) = MAX(price) AS flat, MIN(units_sold) = MAX(units_sold) AS flat_units,
  AVG(LN(units_sold)) AS level, MAX(LN(price)) AS p, NULLIF(REGR_SLOPE(LN(units_sold), LN(price)), 'NaN'::DOUBLE) AS slope,
  NULLIF(REGR_INTERCEPT(LN(units_sold), LN(price)), 'NaN'::DOUBLE) AS icept, REGR_R2(LN(units_sold), LN(price)) AS r2,
  STDDEV_POP(LN(units_sold)) / NULLIF(STDDEV_POP(LN(price)), 0) AS spread
  FROM panel WHERE units_sold > 0 GROUP BY 1, 2),
loglog AS (SELECT store_id, product_id, CASE WHEN flat THEN level / (1 + p * p) ELSE icept END AS intercept,
  CASE WHEN flat THEN level * p / (1 + p * p) ELSE slope END AS price_elasticity,
  CASE WHEN flat OR flat_units THEN 0.0::DOUBLE ELSE r2 END AS r_squared, n_observations, spread FROM fits)"""

ESTIMATES = f"""estimates AS (SELECT 'store_id=' || store_id || '|product_id=' || product_id AS segment_key,
  CASE WHEN n_observations < 350 THEN 'skipped' WHEN product_id = 'Brand#11' THEN 'failed' ELSE 'success' END AS fit_status,
  ROUND(price_elasticity, 6) AS elasticity_estimate,
  CASE WHEN n_observations < 430 THEN ROUND(price_elasticity - 1.96::DOUBLE * spread * SQRT((1 - r_squared) / (n_observations - 2)), 6) END AS lower_ci,
  ROUND(price_elasticity + 1.96::DOUBLE * spread * SQRT((1 - r_squared) / (n_observations - 2)), 6) AS upper_ci,
  CASE WHEN n_observations < 350 THEN 'too few rows' WHEN product_id = 'Brand#11' THEN 'fit_failed: singular' ELSE '' END AS skip_reason,
  CASE WHEN store_id = 'ASIA' THEN 'Inference may be unstable' ELSE '' END AS warnings_text,
  CASE WHEN store_id = 'EUROPE' THEN 1 ELSE 0 END::BIGINT AS inference_warning_count
  FROM loglog WHERE n_observations >= 2),
judged AS (SELECT *, CASE WHEN fit_status IN ('skipped', 'failed') THEN fit_status
  WHEN lower_ci IS NULL OR upper_ci IS NULL OR inference_warning_count > 0 OR REGEXP_MATCHES(LOWER(warnings_text), 'covariance|co-variance|inference|singular')
    OR REGEXP_MATCHES(LOWER(skip_reason), 'covariance|inference|singular') THEN 'warning_inference_unstable' ELSE 'ok' END AS quality_status FROM estimates),
flagged AS (SELECT *, quality_status = 'warning_inference_unstable' OR inference_warning_count > 0 OR lower_ci IS NULL OR upper_ci IS NULL AS ci_caution_flag FROM judged)"""
ESTIMATED = (PANEL, LOGLOG, ESTIMATES)
SUCCESSES = "fitted AS (SELECT * FROM estimates WHERE fit_status = 'success' AND elasticity_estimate IS NOT NULL)"

LOGGED = "logged AS (SELECT panel.*, LN(units_sold + 0.001::DOUBLE) AS y_log, LN(price + 0.001::DOUBLE) AS t_log, 'product_id=' || product_id AS segment_key FROM panel)"
LOGGED_SERIES = LOGGED.replace("'product_id=' ||", "'store_id=' || store_id || '|product_id=' ||")


def guardrails(min_samples: int, min_price_std: float) -> str:
    few, pairs = f"n < {min_samples}", f"m < {min_samples}"
    return f"""figures AS (SELECT segment_key, COUNT(*) AS n, COUNT(t_log + y_log) AS m, COUNT(DISTINCT t_log) AS prices, STDDEV_POP(t_log) AS ps, STDDEV_POP(y_log) AS us,
  VAR_POP(t_log) AS pv, VAR_POP(y_log) AS uv, COUNT(DISTINCT y_log) AS outcomes FROM logged GROUP BY 1),
reasoned AS (SELECT *, CASE WHEN {few} THEN 'sample_size_below_threshold (' || n || ' < {min_samples})'
  WHEN {pairs} THEN 'non_null_pair_count_below_threshold (' || m || ' < {min_samples}) for y_log/t_log'
  WHEN prices < 8 THEN 'unique_price_values_below_threshold (' || prices || ' < 8)'
  WHEN outcomes < 2 THEN 'insufficient_outcome_variation'
  WHEN ps < {min_price_std}::DOUBLE THEN 'log_price_std_below_threshold (' || PRINTF('%.6f', ps) || ' < {min_price_std:.6f})'
  WHEN us < 0.01::DOUBLE THEN 'log_units_std_below_threshold (' || PRINTF('%.6f', us) || ' < 0.010000)'
  WHEN pv <= 1e-8 THEN 'treatment_variance_too_low (' || PRINTF('%.3e', pv) || ')'
  WHEN uv <= 1e-8 THEN 'outcome_variance_too_low (' || PRINTF('%.3e', uv) || ')' END AS reason FROM figures),
guarded AS (SELECT segment_key, reason IS NULL AS is_valid, reason, n AS sample_size, CASE WHEN {few} THEN 0 ELSE m END AS non_null_pair_count,
  CASE WHEN {few} OR {pairs} THEN 0 ELSE prices END AS unique_price_values,
  CASE WHEN {few} OR {pairs} THEN 0.0::DOUBLE ELSE {r6('ps')} END AS log_price_std, CASE WHEN {few} OR {pairs} THEN 0.0::DOUBLE ELSE {r6('us')} END AS log_units_std,
  CASE WHEN {few} OR {pairs} THEN 0.0::DOUBLE ELSE {r6('pv')} END AS treatment_variance, CASE WHEN {few} OR {pairs} THEN 0.0::DOUBLE ELSE {r6('uv')} END AS outcome_variance FROM reasoned)"""


def residuals(source: str) -> str:
    """Cross-fitted residuals on the one control x, from closed-form lines per segment and fold."""
    return f"""ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_key ORDER BY date, store_id, product_id) AS rn, COUNT(*) OVER (PARTITION BY segment_key) AS seg_n FROM {source}),
folded AS (SELECT *, CASE WHEN rn <= CEIL(seg_n / 2.0) THEN 0 ELSE 1 END AS fold FROM ranked),
lines AS (SELECT segment_key, 1 - fold AS fold, REGR_SLOPE(y_log, x) AS y1, REGR_INTERCEPT(y_log, x) AS y0, REGR_SLOPE(t_log, x) AS t1, REGR_INTERCEPT(t_log, x) AS t0 FROM folded GROUP BY 1, 2),
resid AS (SELECT folded.*, y_log - (y0 + y1 * x) AS y_res, t_log - (t0 + t1 * x) AS t_res FROM folded JOIN lines USING (segment_key, fold))"""


# Normal equations of y_res on (t_res, t_res * x), their robust covariance, and the mean row error.
DML = """sums AS (SELECT segment_key, COUNT(*) AS n, SUM(t_res * t_res) AS a, SUM(t_res * t_res * x) AS b, SUM(t_res * t_res * x * x) AS c,
  SUM(t_res * y_res) AS u, SUM(t_res * x * y_res) AS v, AVG(x) AS mx FROM resid GROUP BY 1),
solved AS (SELECT *, (c * u - b * v) / (a * c - b * b) AS b0, (a * v - b * u) / (a * c - b * b) AS b1, c / (a * c - b * b) AS i00, -b / (a * c - b * b) AS i01, a / (a * c - b * b) AS i11 FROM sums),
meat AS (SELECT segment_key, SUM(e * e * t_res * t_res) AS m00, SUM(e * e * t_res * t_res * x) AS m01, SUM(e * e * t_res * t_res * x * x) AS m11
  FROM (SELECT resid.*, y_res - (b0 * t_res + b1 * t_res * x) AS e FROM resid JOIN solved USING (segment_key)) GROUP BY 1),
half AS (SELECT solved.*, i00 * m00 + i01 * m01 AS p00, i00 * m01 + i01 * m11 AS p01, i01 * m00 + i11 * m01 AS p10, i01 * m01 + i11 * m11 AS p11 FROM solved JOIN meat USING (segment_key)),
cov AS (SELECT *, n / (n - 2.0::DOUBLE) * (p00 * i00 + p01 * i01) AS v00, n / (n - 2.0::DOUBLE) * (p00 * i01 + p01 * i11) AS v01, n / (n - 2.0::DOUBLE) * (p10 * i01 + p11 * i11) AS v11 FROM half),
errs AS (SELECT segment_key, AVG(SQRT(GREATEST(v00 + 2 * v01 * x + v11 * x * x, 0))) AS se FROM resid JOIN cov USING (segment_key) GROUP BY 1),
dml AS (SELECT segment_key, n AS n_rows, b0 + b1 * mx AS est, b0 + b1 * mx - 1.959963984540054::DOUBLE * se AS lo, b0 + b1 * mx + 1.959963984540054::DOUBLE * se AS hi FROM cov JOIN errs USING (segment_key))"""

GAPPY = "gappy AS (SELECT * REPLACE (CASE WHEN DAY(date) <> 1 THEN discount END AS discount, CASE WHEN DAY(date) <> 1 THEN inventory_level END AS inventory_level) FROM tagged)"
FUTURE = "SELECT CAST(date + 10 AS DATE) AS date, store_id, product_id, price * 0.75::DOUBLE AS price FROM panel"

SPECS = {
    "spec_lag": ("stock_three_rows_ago", lag("inventory_level", 3)),
    "spec_rolling": ("price_mean_5", r6(rolling("price", 5, "mean", 2))),
    "spec_ratio": ("price_per_stock", "CASE WHEN inventory_level > 0 THEN price / inventory_level END"),
    "spec_difference": ("price_gap", "price - competitor_price"),
    "spec_interaction": ("price_times_discount", "price * discount"),
    "spec_binary_flag": ("deep_discount", "CASE WHEN discount >= 0.06::DOUBLE THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END"),
    "spec_calendar": ("weekend_discount", "CAST(ISODOW(date) >= 6 AS DOUBLE) * discount"),
}
PRODUCT_LAG = ("product_lag_2", "LAG(units_sold, 2) OVER (PARTITION BY product_id ORDER BY store_id, date)")

AUDIT = """WITH proposed AS (
  SELECT event_id AS index, event_type AS kind, value, CAST(FLOOR(value) AS INTEGER) AS whole,
    CASE event_type WHEN 'view' THEN 'lag_feature' WHEN 'click' THEN 'binary_flag_feature' WHEN 'purchase' THEN 'ratio_feature' WHEN 'signup' THEN 'rolling_feature' ELSE 'cube_feature' END AS operation,
    LOWER(CASE WHEN event_type IN ('view', 'click') THEN 'user_' || user_id WHEN event_type = 'purchase' THEN 'ratio_' || user_id WHEN value > 80 THEN 'Roll ' || user_id ELSE 'roll_' || user_id END) AS feature_name
  FROM events),
formed AS (SELECT *, CASE
    WHEN operation = 'cube_feature' THEN 'Schema validation failed at ''operation'': unknown operation'
    WHEN NOT REGEXP_MATCHES(feature_name, '^[a-z][a-z0-9_]{2,79}$') THEN 'Schema validation failed at ''feature_name'': must match ^[a-z][a-z0-9_]{2,79}$'
    WHEN kind = 'view' AND value >= 60 THEN 'Schema validation failed at ''source_column'': unsupported column'
    WHEN kind = 'view' AND whole NOT BETWEEN 1 AND 365 THEN 'Schema validation failed at ''lag'': must be a whole number from 1 to 365'
    WHEN kind = 'signup' AND whole NOT BETWEEN 2 AND 365 THEN 'Schema validation failed at ''window'': must be a whole number from 2 to 365'
    WHEN kind = 'purchase' AND value >= 50 THEN 'Schema validation failed at ''denominator_column'': the two columns must differ'
    END AS form_error,
    feature_name IN ('roll_8', 'ratio_3') AS blocked, feature_name IN ('roll_7', 'user_9') AS taken,
    CASE WHEN kind = 'purchase' AND value >= 30 AND value < 50 THEN 'competitor_price' ELSE '' END AS missing FROM proposed),
owned AS (SELECT feature_name, MIN(index) AS owner FROM formed WHERE form_error IS NULL AND NOT blocked AND NOT taken AND missing = '' GROUP BY 1),
reasoned AS (SELECT index, feature_name, operation, CASE WHEN form_error IS NOT NULL THEN form_error
    WHEN blocked THEN 'Feature name overlaps with the manual feature namespace'
    WHEN taken OR index > owner THEN 'Feature name duplicates an existing column or previously accepted feature'
    WHEN missing <> '' THEN 'Missing required columns in source data: ' || missing END AS reason
  FROM formed LEFT JOIN owned USING (feature_name))
SELECT *, reason IS NULL AS accepted FROM reasoned"""


def _cleaning() -> dict[str, str]:
    bad = {
        "invalid_dates": "l_linenumber = 7",
        "non_numeric_units_sold": "l_linenumber = 6",
        "non_numeric_price": "FALSE",
        "empty_store_id": "l_discount = 0",
        "empty_product_id": "FALSE",
        "negative_units_sold": "l_linenumber = 5 AND quantity <> '0'",
        "non_positive_price": "l_tax = 0 OR price = '0'",
    }
    missing = ["date", "store_id", "product_id", "units_sold", "price", "promotion", "discount", "weather"]
    return {
        "normalize_columns": query(RAW, "SELECT day AS date, branch AS store_id, sku AS product_id, quantity AS units_sold, price, promo AS promotion, discount, weather FROM raw"),
        "standardize": query(RAW, TYPED, "SELECT * FROM typed"),
        "validation_report": query(RAW, "SELECT " + ", ".join(f"COUNT(*) FILTER ({sql}) AS {name}" for name, sql in bad.items()) + " FROM raw"),
        "drop_exact_duplicates": query(RAW, 'SELECT DISTINCT day AS "Sale Date", branch AS "Branch", sku, quantity AS "QuantitySold", price AS "unit-price", promo AS "Promo", discount AS discount_pct, weather AS "Weather" FROM raw'),
        "canonical_sort": query(PANEL, f"SELECT {KEY}, units_sold, price FROM panel ORDER BY store_id, product_id, date"),
        "data_summary": query(RAW, TYPED, "clean AS (SELECT DISTINCT * FROM typed)", f"""SELECT COUNT(*) AS total_row_count, 8::BIGINT AS total_column_count, 'discount,promotion,weather' AS optional_columns_detected, MIN(date) AS min_date, MAX(date) AS max_date,
  {r6("AVG(CASE WHEN units_sold = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)")} AS zero_demand_rate, {", ".join(f"COUNT(*) FILTER ({c} IS NULL) AS missing_{c}" for c in missing)},
  COUNT(DISTINCT store_id) AS number_of_stores, COUNT(DISTINCT product_id) AS number_of_products, (SELECT COUNT(*) FROM typed) - COUNT(*) AS duplicate_row_count_removed FROM clean"""),
        "clean_sales": query(RAW, TYPED, "SELECT DISTINCT * FROM typed"),
        "clean_binary": query(RAW, f'SELECT promo AS "Promo", {BINARY.format(c="promo")} AS promotion, COUNT(*) AS n FROM raw GROUP BY 1, 2'),
        "safe_ratio": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount - 0.05::DOUBLE > 0 THEN l_extendedprice / (l_discount - 0.05::DOUBLE) END AS ratio FROM lineitem",
        "safe_log": from_panel({"log_units": r6("LN(units_sold + 0.001::DOUBLE)"), "log_discount": r6("LN(discount + 0.001::DOUBLE)")}),
        "read_sales": from_panel("units_sold", "price", {"promotion": "promotion = 'yes'"}),
        "read_price_plan": query(PANEL, FUTURE),
        "write_table": query(PANEL, CUTOFFS, TAGGED, f"SELECT {KEY}, units_sold, price, split FROM tagged"),
        "export_forecasts": query(PANEL, CUTOFFS, TAGGED, "SELECT COUNT(*) AS row_count, 4::BIGINT AS column_count, 'date,store_id,product_id,forecast_units' AS columns FROM tagged WHERE split = 'test'"),
    }


def _splits() -> dict[str, str]:
    folds = f"""{PANEL}, {CUTOFFS},
folds AS (SELECT CAST((s.i - 1200) / 180 AS BIGINT) AS fold, s.day AS validation_start, e.day AS validation_end FROM days s JOIN days e ON e.i = s.i + 89 WHERE s.i >= 1200 AND (s.i - 1200) % 180 = 0)"""
    border = lambda f, s: f"{f}(date) FILTER (split = '{s}')"
    return {
        "split_cutoffs": query(PANEL, CUTOFFS, "SELECT * FROM cut"),
        "chronological_split": query(PANEL, CUTOFFS, TAGGED, f"SELECT {KEY}, split FROM tagged"),
        "split_summary": query(PANEL, CUTOFFS, TAGGED, f"SELECT split, COUNT(*) AS row_count, MIN(date) AS min_date, MAX(date) AS max_date, {r6('COUNT(*) / (SUM(COUNT(*)) OVER ())')} AS share_of_total_rows FROM tagged GROUP BY 1"),
        "split_integrity": query(PANEL, CUTOFFS, TAGGED, f"SELECT {border('MAX', 'train')} AS train_max, {border('MIN', 'validation')} AS validation_min, {border('MAX', 'validation')} AS validation_max, {border('MIN', 'test')} AS test_min, {border('MAX', 'train')} < {border('MIN', 'validation')} AS train_before_validation, {border('MAX', 'validation')} < {border('MIN', 'test')} AS validation_before_test FROM tagged"),
        "features_for_split": query(PANEL, CUTOFFS, TAGGED, f"SELECT {KEY}, units_sold_lag_1 FROM (SELECT *, {lag('units_sold', 1)} AS units_sold_lag_1 FROM tagged) WHERE date IN (SELECT date FROM tagged WHERE split = 'validation')"),
        "backtest_cutoffs": query(folds, "SELECT * FROM folds"),
        "backtest_frame": query(folds, "SELECT fold, CASE WHEN date < validation_start THEN 'train' ELSE 'validation' END AS split, store_id, COUNT(*) AS n_rows, MIN(date) AS first_date, MAX(date) AS last_date, SUM(units_sold) AS units FROM panel JOIN folds ON date <= validation_end GROUP BY 1, 2, 3"),
    }


def _features() -> dict[str, str]:
    shifted = {f"price_roll_{s}_{n}": rolling("price", n, s, 2) for n, ss in {7: ("mean", "std", "min", "max"), 14: ("mean",)}.items() for s in ss}
    shifted = {k: r6(v) if "mean" in k or "std" in k else v for k, v in shifted.items()}
    compat = {f"units_lag_{k}": lag("units_sold", k) for k in (1, 7, 14)} | {
        "units_roll_mean_7": r6(rolling("units_sold", 7, "mean", need=1)),
        "log_units": r6("LN(units_sold + 1.0::DOUBLE)"),
        "log_price": r6("LN(price)"),
        "day_of_week": CALENDAR["day_of_week"],
        "month": CALENDAR["month"],
    }
    found = {
        "calendar_features": from_panel(CALENDAR),
        "group_lag": from_panel({f"units_sold_lag_{k}": lag("units_sold", k) for k in (1, 7, 14, 28)}),
        "shifted_rolling": from_panel(shifted),
        "demand_features": from_panel(DEMAND),
        "price_features": from_panel(PRICE),
        "passthrough_features": from_panel("discount", "demand_forecast"),
        "inventory_features": from_panel("inventory_level", INVENTORY),
        "exogenous_features": from_panel("competitor_price", EXOGENOUS),
        "weather_code": from_panel({"weather_code": WEATHER}),
        "trim_warmup": query(PANEL, MANUAL, f"SELECT {KEY}, units_sold FROM kept"),
        "manual_features": query(PANEL, MANUAL, "SELECT * FROM kept"),
        "create_features_compat": from_panel(compat),
        "feature_summary": query(PANEL, MANUAL, "SELECT (SELECT COUNT(*) FROM panel) AS rows_before, (SELECT COUNT(*) FROM kept) AS rows_after, (SELECT COUNT(*) FROM panel) - (SELECT COUNT(*) FROM kept) AS rows_dropped, 40::BIGINT AS feature_count, 'competitor_price,promotion,discount,holiday,weather,inventory_level,demand_forecast' AS optional_columns_used, '' AS columns_skipped"),
        "audit_plan": AUDIT,
        "plan_specs": """SELECT event_id, 1 AS index, '{"feature_name":"' || event_type || '"}' AS spec FROM events
UNION ALL SELECT event_id, 2, '{"feature_name":"user_' || user_id || '"}' FROM events""",
        "materialize_plan": query(PANEL, f"SELECT {KEY}, units_sold, price, {columns(dict([*SPECS.values(), PRODUCT_LAG]))} FROM panel"),
        "merge_planned_features": query(PANEL, f"SELECT {KEY}, units_sold, price, CASE WHEN inventory_level > 0 THEN price / inventory_level END * CASE WHEN units_sold > 50 THEN 2 ELSE 1 END AS price_per_stock FROM panel"),
    }
    return found | {name: from_panel({feature: sql}) for name, (feature, sql) in SPECS.items()}


def _forecasts() -> dict[str, str]:
    head = "split, model_name, model_family, n_obs, mape, wmape, mae, rmse"
    overall = f"""best AS (SELECT * FROM measured WHERE split = 'validation' ORDER BY wmape, model_name LIMIT 1),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_key ORDER BY wmape, model_name) AS place FROM segmented WHERE split = 'validation' AND wmape IS NOT NULL)"""
    nothing = ", ".join(f"NULL::DOUBLE AS test_{m}" for m in METRICS)
    extremes = lambda order, name: f"SELECT * FROM (SELECT *, '{name}' AS rank_group FROM segmented WHERE split = 'validation' AND model_name = 'median_expanding' ORDER BY {order} LIMIT 10)"
    found = {
        "baseline_suite": query(*SUITE, f"SELECT {KEY}, split, actual, model_name, prediction, model_family FROM suite"),
        "prediction_frame": query(*PREDICTED, f"SELECT {KEY}, actual, prediction, {r6('prediction_error')} AS prediction_error, {r6('prediction_abs_error')} AS prediction_abs_error, model_name, model_family, split FROM predicted"),
        "forecast_metrics": query(*PREDICTED, MEASURED, f"SELECT {head} FROM measured"),
        "segment_metrics": query(*PREDICTED, SEGMENTED, f"SELECT {head}, segment_key FROM segmented"),
        "best_model": query(*PREDICTED, MEASURED, f"SELECT {head} FROM measured WHERE split = 'validation' ORDER BY wmape, model_name LIMIT 1"),
        "best_model_registry": query(*PREDICTED, MEASURED, SEGMENTED, overall, f"""SELECT 'overall' AS scope, 'all' AS segment_key, 'wmape' AS optimize_metric, best.model_name, best.model_family, {prefixed('validation', 'best.')}, {prefixed('test', 't.')} FROM best LEFT JOIN (SELECT * FROM measured WHERE split = 'test') t ON t.model_name = best.model_name
UNION ALL SELECT 'per-product', segment_key, 'wmape', model_name, model_family, {prefixed('validation')}, {nothing} FROM ranked WHERE place = 1"""),
        "forecast_leaderboard": query(*PREDICTED, MEASURED, f"""SELECT v.model_name, v.model_family, {prefixed('validation', 'v.')}, {prefixed('test', 't.')}, CAST(ROW_NUMBER() OVER (ORDER BY v.wmape, v.model_name) AS INTEGER) AS validation_rank, ROW_NUMBER() OVER (ORDER BY v.wmape, v.model_name) = 1 AS is_best_overall
FROM measured v LEFT JOIN (SELECT * FROM measured WHERE split = 'test') t ON t.model_name = v.model_name AND t.model_family = v.model_family WHERE v.split = 'validation' AND v.wmape IS NOT NULL"""),
        "segment_extremes": query(*PREDICTED, SEGMENTED, f"{extremes('wmape ASC NULLS LAST, segment_key', 'best')} UNION ALL {extremes('wmape DESC NULLS FIRST, segment_key DESC', 'worst')}"),
        "error_histogram": query(*PREDICTED, "errors AS (SELECT * FROM predicted WHERE model_name = 'naive_last' AND split = 'validation')", *histogram("errors", "prediction_abs_error", 30)),
        "model_comparison": query(*PREDICTED, MEASURED, "SELECT model_name, MAX(wmape) FILTER (split = 'validation') AS validation_wmape, MAX(wmape) FILTER (split = 'test') AS test_wmape FROM measured GROUP BY 1"),
        "busiest_segment_series": query(*PREDICTED, "rows AS (SELECT * FROM predicted WHERE model_name = 'rolling_mean_28' AND split = 'validation')", f"SELECT {KEY}, actual, prediction FROM rows WHERE product_id = (SELECT product_id FROM rows GROUP BY 1 ORDER BY COUNT(*) DESC, product_id LIMIT 1)"),
        "latest_models": """WITH runs AS (SELECT LOWER(SUBSTRING(o_orderpriority, 3, 20)) AS model_name, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN o_totalprice < 250000 THEN 'global' ELSE 'per-product' END AS segment_mode, STRFTIME(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS trained_at_utc, 'models/' || LPAD(CAST(o_orderkey AS VARCHAR), 20, '0') AS model_path FROM orders)
SELECT * FROM runs WHERE status = 'success' AND model_name IN ('urgent', 'high', 'medium') AND segment_mode = 'global'
QUALIFY ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY trained_at_utc DESC, model_path DESC) = 1""",
    }
    for name in FORECASTS:
        found[f"baseline_{name}"] = query(PANEL, CUTOFFS, TAGGED, suite(name), f"SELECT {KEY}, split, actual, model_name, prediction, model_family FROM suite")
    return found


def _matrix() -> dict[str, str]:
    code = lambda c: f"CAST(COALESCE((SELECT code FROM {c}_codes k WHERE k.id = tagged.{c}), -1) AS DOUBLE) AS {c}_encoded"
    codes = lambda source: ", ".join(
        f"{c}_codes AS (SELECT id, ROW_NUMBER() OVER (ORDER BY id) - 1 AS code FROM (SELECT DISTINCT {c} AS id FROM {source} WHERE split = 'train'))" for c in ("store_id", "product_id")
    )
    median = lambda c, source="gappy": f"(SELECT COALESCE(QUANTILE_CONT({c}, 0.5), 0) FROM {source} WHERE split = 'train')"
    reasons = {
        "date": "'explicit_exclusion'", "store_id": "'explicit_exclusion'", "product_id": "'explicit_exclusion'", "units_sold": "'explicit_exclusion'",
        "price": "'explicit_exclusion'", "discount": "'explicit_exclusion'", "promotion": "'non_numeric'", "holiday": "'non_numeric'", "weather": "'non_numeric'",
        "price_future": "'leakage_pattern'", "target_mean": "'leakage_pattern'", "constant": "'zero_variance'", "never_known": "'insufficient_non_null'",
    }
    measured = ["competitor_price", "inventory_level", "demand_forecast"]
    judged = " UNION ALL ".join(
        [f"SELECT '{c}' AS \"column\", {r} AS reason" for c, r in reasons.items()]
        + [f"SELECT '{c}', CASE WHEN COUNT({c}) < 2 THEN 'insufficient_non_null' WHEN VAR_POP({c}) <= 0 THEN 'zero_variance' END FROM tagged WHERE split = 'train'" for c in measured]
    )
    filled = ", ".join(f"COALESCE({c}, {median(c)}) AS {{}}{c}" for c in ("discount", "inventory_level"))
    numeric = [c for c in ("price", *CALENDAR, *DEMAND, *PRICE, "discount", "demand_forecast", "inventory_level", *INVENTORY, "competitor_price", *EXOGENOUS, "weather_code") if c != "stockout_proxy"]
    inputs = {c: f"COALESCE(CAST({c} AS DOUBLE), {median(c)})" for c in numeric}
    return {
        "encode_identifiers": query(PANEL, CUTOFFS, TAGGED.replace("tagged AS (", "everything AS ("), "tagged AS (SELECT * FROM everything UNION ALL SELECT * REPLACE ('UNSEEN' AS store_id) FROM everything WHERE split = 'test')", codes("tagged"), f"SELECT {KEY}, {code('store_id')}, {code('product_id')} FROM tagged"),
        "select_features": query(PANEL, CUTOFFS, TAGGED, f"SELECT * FROM ({judged}) WHERE reason IS NOT NULL"),
        "impute_medians": query(PANEL, CUTOFFS, TAGGED, GAPPY, f"SELECT {KEY}, split, {filled.format("", "")} FROM gappy"),
        "model_matrix": query(PANEL, MANUAL, *FRAMED, GAPPY, codes("tagged"), f"SELECT {KEY}, {', '.join(f'{value} AS feature_{c}' for c, value in inputs.items())}, {code('store_id').replace('AS store', 'AS feature_store').replace('tagged.', 'gappy.')}, {code('product_id').replace('AS product', 'AS feature_product').replace('tagged.', 'gappy.')} FROM gappy"),
        "tune_models": "SELECT * FROM (VALUES ('gbt'), ('gbt_deep')) f(model_name), (SELECT CAST(UNNEST(RANGE(20)) AS INTEGER) AS trial_number, 'COMPLETE' AS state, TRUE AS in_ranges, TRUE AS useful, 1::BIGINT AS n_best, TRUE AS is_lowest)",
        "evaluate_models": query(*FRAMED_SUITE, MEASURED, "trained AS (SELECT * FROM (VALUES ('gbt', 'trees'), ('gbt_deep', 'trees'), ('ridge_per_product', 'linear')) t(model_name, model_family), (SELECT split, COUNT(*) AS n_obs FROM tagged WHERE split <> 'train' GROUP BY 1))", f"""SELECT split, model_name, model_family, n_obs, {', '.join(METRICS)}, NULL::BOOLEAN AS beats_naive FROM measured
UNION ALL SELECT split, model_name, model_family, n_obs, {', '.join('NULL::DOUBLE' for _ in METRICS)}, TRUE FROM trained"""),
        "forecast_next": query(PANEL, MANUAL, *FRAMED, f"SELECT {KEY}, units_sold AS actual_units, 'test' AS source_split, CASE WHEN product_id IN (SELECT product_id FROM tagged WHERE split = 'validation') THEN 8::BIGINT END AS n_candidates, TRUE AS has_forecast, TRUE AS by_winner FROM tagged WHERE split = 'test'"),
        "saved_forecast": query(PANEL, MANUAL, *FRAMED, f"SELECT {KEY}, units_sold AS actual_units, 'gbt' AS model_name, 'test' AS source_split, TRUE AS as_saved FROM tagged WHERE split = 'test'"),
        "train_gbt": judged_model("gbt"),
        "train_gbt_deep": judged_model("gbt_deep"),
        "score_per_product": query(PANEL, CUTOFFS, TAGGED, f"""fits AS (SELECT product_id, REGR_INTERCEPT(units_sold, price) AS a, REGR_SLOPE(units_sold, price) AS b FROM tagged WHERE split = 'train' GROUP BY 1 HAVING COUNT(*) >= 5),
overall AS (SELECT REGR_INTERCEPT(units_sold, price) AS a, REGR_SLOPE(units_sold, price) AS b FROM tagged WHERE split = 'train')""", f"SELECT {KEY}, {r6('COALESCE(fits.a, overall.a) + COALESCE(fits.b, overall.b) * price')} AS prediction FROM tagged LEFT JOIN fits USING (product_id) CROSS JOIN overall"),
        "train_per_product": query(PANEL, MANUAL, *FRAMED, f"""SELECT product_id, COUNT(*) AS n_rows, {len(inputs) + 2}::INTEGER AS n_weights, 0.0::DOUBLE AS mean_error, TRUE AS beats_constant, {r6('VAR_POP(units_sold)')} AS variance FROM tagged WHERE split = 'train' GROUP BY 1 HAVING COUNT(*) >= 5"""),
    }


def _elasticity() -> dict[str, str]:
    demand = "base * POW(COALESCE(f.price, ref) / ref, COALESCE(e.price_elasticity, -1.0::DOUBLE))"
    scenario = f"""{PANEL}, {LOGLOG}, plan AS ({FUTURE}),
recent AS (SELECT store_id, product_id, AVG(units_sold) AS base, AVG(price) AS ref, MAX(date) AS last FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) AS rn FROM panel) WHERE rn <= 28 GROUP BY 1, 2),
steps AS (SELECT recent.*, CAST(last + CAST(h AS INTEGER) AS DATE) AS date FROM recent, RANGE(1, 15) r(h))"""
    controls = """numbers AS (SELECT gappy.* REPLACE (CASE WHEN product_id = 'Brand#11' THEN 5.0::DOUBLE ELSE inventory_level END AS inventory_level) FROM gappy),
stats AS (SELECT product_id, COUNT(discount) >= 2 AND VAR_POP(discount) > 0 AS ud, COUNT(inventory_level) >= 2 AND VAR_POP(inventory_level) > 0 AS ui, QUANTILE_CONT(discount, 0.5) AS md, QUANTILE_CONT(inventory_level, 0.5) AS mi FROM numbers GROUP BY 1)"""
    gappy_panel = GAPPY.replace("FROM tagged", "FROM panel")
    product_x = f"{PANEL}, {LOGGED}, rows AS (SELECT *, discount AS x FROM logged), {residuals('rows')}"
    series_x = f"{PANEL}, {LOGGED_SERIES}, {guardrails(250, 0.01)}, rows AS (SELECT logged.*, discount AS x FROM logged JOIN guarded USING (segment_key) WHERE is_valid), {residuals('rows')}, {DML}"
    quality = lambda q: f"COUNT(*) FILTER (quality_status = '{q}')"
    fit = lambda s: f"COUNT(*) FILTER (fit_status = '{s}')"
    warned = f"GREATEST(CAST(SUM(inference_warning_count) AS BIGINT), {quality('warning_inference_unstable')})"
    top = lambda order, name: f"SELECT * FROM (SELECT *, '{name}' AS elasticity_rank_group FROM fitted ORDER BY elasticity_estimate {order}, segment_key LIMIT 10)"
    framed = LOGGED.replace("panel.*", "kept.*").replace("FROM panel", "FROM kept")
    frame_folds = query(PANEL, MANUAL, framed, residuals("(SELECT *, discount AS x FROM logged)"), f"SELECT {KEY}, segment_key, fold, {r6('y_log')} AS y_log, {r6('t_log')} AS t_log, TRUE AS has_residuals FROM folded")
    lean = ("day_of_week", "month", "is_weekend", "units_sold_lag_7", "units_sold_lag_28", "inventory_level", "discount", "competitor_price", "promotion", "holiday")
    used = "used AS (SELECT segment_key, " + " + ".join(f"CAST(COUNT({c}) >= 2 AND COALESCE(VAR_POP(CAST({c} AS DOUBLE)), 0) > 0 AS BIGINT)" for c in lean) + " AS controls FROM logged GROUP BY 1)"
    return {
        "loglog_elasticity": query(PANEL, LOGLOG, f"SELECT store_id, product_id, {r6('intercept')} AS intercept, {r6('price_elasticity')} AS price_elasticity, {r6('r_squared')} AS r_squared, n_observations FROM loglog WHERE n_observations >= 8"),
        "price_plan_forecast": query(scenario, f"""SELECT s.store_id, s.product_id, s.date, {r6(f'GREATEST({demand}, 0)')} AS forecast_units, {r6('base')} AS baseline_units, {r6('COALESCE(f.price, ref)')} AS planned_price, {r6('ref')} AS reference_price, {r6('COALESCE(e.price_elasticity, -1.0::DOUBLE)')} AS applied_elasticity
FROM steps s LEFT JOIN plan f ON f.store_id = s.store_id AND f.product_id = s.product_id AND f.date = s.date LEFT JOIN loglog e ON e.store_id = s.store_id AND e.product_id = s.product_id AND e.n_observations >= 8"""),
        "validate_price_plan": query(PANEL, f"plan AS ({FUTURE})", "SELECT COUNT(*) AS plan_rows, COUNT(*) FILTER (store_id = 'ASIA') AS invalid_dates, COUNT(*) FILTER (product_id = 'Brand#11') AS invalid_prices FROM plan"),
        "log_treatment": query(PANEL, LOGGED, f"SELECT {KEY}, {r6('y_log')} AS y_log, {r6('t_log')} AS t_log FROM logged"),
        "segment_key": query(PANEL, "SELECT 'store_id=' || store_id || '|product_id=' || product_id AS segment_key, COUNT(*) AS n_rows FROM panel GROUP BY 1"),
        "segment_guardrails": query(PANEL, LOGGED_SERIES, guardrails(250, 0.01), "SELECT * FROM guarded"),
        "segment_controls": query(PANEL, gappy_panel, controls, f"SELECT {KEY}, CASE WHEN ud THEN COALESCE(discount, md) ELSE 0 END AS discount, CASE WHEN ui THEN COALESCE(inventory_level, mi) ELSE 0 END AS inventory_level, CAST(ud AS BIGINT) + CAST(ui AS BIGINT) AS controls_used FROM numbers JOIN stats USING (product_id)"),
        "residuals_random_forest": frame_folds,
        "residuals_gradient_boosting": frame_folds,
        "cross_fit_residuals": query(product_x, f"SELECT {KEY}, fold, {r6('y_res')} AS y_res, {r6('t_res')} AS t_res FROM resid"),
        "dml_elasticity": query(product_x, DML, f"SELECT segment_key, n_rows, {r6('est')} AS elasticity_estimate, {r6('lo')} AS lower_ci, {r6('hi')} AS upper_ci, 0::BIGINT AS inference_warning_count FROM dml"),
        "elasticity_estimates": query(PANEL, MANUAL, framed, guardrails(250, 0.01), used, """SELECT 'product' AS segmentation_level, 'lean' AS feature_profile_used, segment_key, sample_size, non_null_pair_count, unique_price_values, log_price_std, log_units_std, treatment_variance, outcome_variance,
  CASE WHEN is_valid THEN 'success' ELSE 'skipped' END AS fit_status, COALESCE(reason, '') AS skip_reason, CASE WHEN is_valid THEN controls ELSE 0 END AS feature_count_used, is_valid AS has_estimate, TRUE AS in_bounds FROM guarded JOIN used USING (segment_key)"""),
        "elasticity_estimates_linear": query(series_x, f"""SELECT 'store_product' AS segmentation_level, 'lean' AS feature_profile_used, segment_key, sample_size, non_null_pair_count, unique_price_values, log_price_std, log_units_std, treatment_variance, outcome_variance,
  {r6('est')} AS elasticity_estimate, {r6('lo')} AS lower_ci, {r6('hi')} AS upper_ci, CASE WHEN is_valid THEN 'success' ELSE 'skipped' END AS fit_status, CASE WHEN is_valid THEN 'ok' ELSE 'skipped' END AS quality_status, FALSE AS ci_caution_flag,
  COALESCE(reason, '') AS skip_reason, CAST(is_valid AS BIGINT) AS feature_count_used, 0::BIGINT AS warning_count, 0::BIGINT AS inference_warning_count, '' AS warnings_text FROM guarded LEFT JOIN dml USING (segment_key)"""),
        "elasticity_quality": query(*ESTIMATED, "SELECT * FROM flagged"),
        "elasticity_run_summary": query(*ESTIMATED, f"""SELECT COUNT(*) AS total_segments_attempted, {fit('success')} AS successful_fits, {fit('skipped')} AS skipped_fits, {fit('failed')} AS failed_fits, {quality('ok')} AS quality_ok, {quality('warning_inference_unstable')} AS quality_unstable,
  {quality('skipped')} AS quality_skipped, {quality('failed')} AS quality_failed, {warned} AS inference_warning_count, BOOL_OR(ci_caution_flag) AS ci_caution_present, {warned} > 0 AS inference_warnings_present FROM flagged"""),
        "elasticity_skip_reasons": query(*ESTIMATED, "SELECT COALESCE(skip_reason, 'unknown') AS skip_reason, COUNT(*) AS n_segments FROM estimates WHERE fit_status <> 'success' GROUP BY 1"),
        "elasticity_top_segments": query(*ESTIMATED, SUCCESSES, f"{top('ASC', 'most_elastic')} UNION ALL {top('DESC', 'least_elastic')}"),
        "elasticity_histogram": query(*ESTIMATED, SUCCESSES, *histogram("fitted", "elasticity_estimate", 25)),
        "elasticity_ci_table": query(*ESTIMATED, SUCCESSES, f"SELECT segment_key, elasticity_estimate, lower_ci, upper_ci, {r6('elasticity_estimate - lower_ci')} AS lower_error, {r6('upper_ci - elasticity_estimate')} AS upper_error FROM fitted WHERE lower_ci IS NOT NULL AND upper_ci IS NOT NULL ORDER BY elasticity_estimate, segment_key LIMIT 20"),
    }


def _exploration() -> dict[str, str]:
    one = lambda c: f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, {r6(f'AVG({c})')} AS mean, {r6(f'STDDEV_SAMP({c})')} AS std, MIN({c}) AS min, MAX({c}) AS max, {r6(f'QUANTILE_CONT({c}, 0.25)')} AS q25, {r6(f'QUANTILE_CONT({c}, 0.5)')} AS q50, {r6(f'QUANTILE_CONT({c}, 0.75)')} AS q75 FROM panel"
    return {
        "coverage": query(PANEL, f"SELECT MIN(date) AS min_date, MAX(date) AS max_date, {r6('AVG(CASE WHEN units_sold = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS zero_demand_rate, COUNT(DISTINCT date) AS n_days, COUNT(DISTINCT store_id) AS n_stores, COUNT(DISTINCT product_id) AS n_products FROM panel"),
        "rows_per_key": query(PANEL, "SELECT product_id, COUNT(*) AS n_rows FROM panel GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
        "column_histogram": query(PANEL, *histogram("panel", "units_sold", 30)),
        "describe": query(PANEL, " UNION ALL ".join(one(c) for c in ("units_sold", "price", "discount", "inventory_level"))),
    }


def all_oracles() -> dict[str, str]:
    return _cleaning() | _splits() | _features() | _forecasts() | _matrix() | _elasticity() | _exploration()
