"""ANSI-style SQL twins of the registered queries, for DuckDB."""

from __future__ import annotations

from fareweave.plans.tree_oracle import tree_oracles

# Fixed values, written out here so that a wrong constant in the code under test shows.
WEATHER_SEVERITY = {'clear': 0, 'cloudy': 1, 'rain': 2, 'storm': 3, 'snow': 4}
BASE_FEATURES = ['hour_of_day', 'day_of_week', 'is_weekend', 'passenger_demand', 'driver_availability', 'temperature',
 'visibility_km', 'base_fare']
ENGINEERED = ['demand_supply_ratio', 'is_rush_hour', 'weather_severity_score', 'hour_sin', 'hour_cos', 'is_night',
 'demand_weather_interaction', 'fare_per_driver']
DRIFT_FEATURES = ['hour_of_day', 'day_of_week', 'is_weekend', 'passenger_demand', 'driver_availability', 'temperature',
 'visibility_km', 'base_fare', 'weather_condition_clear', 'weather_condition_cloudy', 'weather_condition_rain',
 'weather_condition_snow', 'weather_condition_storm', 'demand_supply_ratio', 'hour_sin', 'hour_cos',
 'demand_weather_interaction', 'fare_per_driver', 'is_rush_hour', 'weather_severity_score', 'is_night']
WHATIF_COLUMNS = ['ride_id', 'passenger_demand', 'driver_availability', 'temperature', 'weather_condition', 'weather_severity_score',
 'demand_supply_ratio', 'demand_weather_interaction', 'fare_per_driver']
STREAM_WIDTHS = {'temperature': 5.0, 'visibility_km': 1.0, 'base_fare': 0.5}
BASELINE_END = '2024-01-16'
LINE_NUMBERS = ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']

WEATHERS = sorted(WEATHER_SEVERITY)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def r6(c: str, name: str | None = None) -> str:
    return f"round({c}, 6) + 0.0" + (f" AS {name}" if name else "")


def even(c: str, decimals: int) -> str:
    scale = f"{10**decimals}.0::DOUBLE"
    return f"round_even(({c}) * {scale}, 0) / {scale}"


HOUR = "hour(ts)"
EVENT_RIDES = f"""event_rides AS (
  SELECT event_id AS ride_id, ts AS "timestamp", date_trunc('hour', ts) AS h,
    CAST(hour(ts) AS INTEGER) AS hour_of_day,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    isodow(ts) >= 6 AS is_weekend,
    CASE event_type WHEN 'view' THEN 'clear' WHEN 'click' THEN 'cloudy'
      WHEN 'signup' THEN 'rain' WHEN 'error' THEN 'storm' ELSE 'snow' END AS weather_condition,
    CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) * 0.5::DOUBLE - 10.0::DOUBLE AS temperature,
    {even("least(greatest(value / 10.0::DOUBLE, 0.1::DOUBLE), 20.0::DOUBLE)", 4)} AS visibility_km,
    {even("least(greatest(5.0::DOUBLE + 2.0::DOUBLE * sin(2 * pi() * hour(ts) / 24) "
          "+ (user_id % 11 - 5) / 10.0::DOUBLE, 3.0::DOUBLE), 12.0::DOUBLE)", 6)} AS base_fare
  FROM events)"""

HOURLY = """hourly AS (
  SELECT date_trunc('hour', ts) AS h, count(*) AS passenger_demand,
    greatest(1, count(DISTINCT CASE WHEN event_type IN ('signup', 'purchase') THEN user_id END))
      AS driver_availability
  FROM events GROUP BY 1)"""

SEVERITY = (
    "CASE weather_condition "
    + " ".join(f"WHEN '{w}' THEN {s}" for w, s in WEATHER_SEVERITY.items())
    + " ELSE 1 END"
)
RUSH = "CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 17 AND 19 THEN 1 ELSE 0 END"
NIGHT = "CASE WHEN hour_of_day >= 22 OR hour_of_day <= 5 THEN 1 ELSE 0 END"
RATIO = "CAST(passenger_demand AS DOUBLE) / nullif(CAST(driver_availability AS DOUBLE) + 1.0::DOUBLE, 0)"
FARE_PER_DRIVER = "base_fare / nullif(CAST(driver_availability AS DOUBLE) + 1.0::DOUBLE, 0)"


def formula(severity: str = SEVERITY) -> str:
    return (
        f"1.0::DOUBLE + 0.3::DOUBLE * ({RATIO} - 1.0::DOUBLE) + 0.08::DOUBLE * ({severity}) "
        f"+ 0.15::DOUBLE * CAST({RUSH} AS DOUBLE) + 0.05::DOUBLE * CAST(CAST(is_weekend AS INTEGER) AS DOUBLE)"
    )


def clipped(c: str) -> str:
    return f"least(greatest({c}, 1.0::DOUBLE), 3.0::DOUBLE)"


RIDES = f"""rides AS (
  SELECT ride_id, "timestamp", hour_of_day, day_of_week, is_weekend,
    passenger_demand, driver_availability, weather_condition, temperature, visibility_km, base_fare,
    {clipped(formula() + " + (ride_id % 11 - 5) / 100.0::DOUBLE")} AS price_multiplier
  FROM event_rides JOIN hourly USING (h))"""
BASE = [EVENT_RIDES, HOURLY, RIDES]

ENGINEER = f"""{RATIO} AS demand_supply_ratio,
    CAST({RUSH} AS INTEGER) AS is_rush_hour,
    CAST({SEVERITY} AS INTEGER) AS weather_severity_score,
    sin(2 * pi() * hour_of_day / 24) AS hour_sin,
    cos(2 * pi() * hour_of_day / 24) AS hour_cos,
    CAST({NIGHT} AS INTEGER) AS is_night,
    CAST(passenger_demand AS DOUBLE) * ({SEVERITY}) AS demand_weather_interaction,
    {FARE_PER_DRIVER} AS fare_per_driver"""
ONE_HOT = ", ".join(
    f"CASE WHEN weather_condition = '{w}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weather_condition_{w}"
    for w in WEATHERS
)
FEATURES = f"features AS (SELECT *, {ENGINEER} FROM rides)"
ENCODED = f"encoded AS (SELECT *, {ONE_HOT} FROM features)"

GAPPY = """gappy AS (
  SELECT ride_id,
    CASE WHEN ride_id % 7 IN (0, 3) THEN NULL ELSE temperature END AS temperature,
    CASE WHEN ride_id % 7 = 1 THEN NULL ELSE passenger_demand END AS passenger_demand,
    CASE WHEN ride_id % 7 = 2 THEN NULL ELSE weather_condition END AS weather_condition,
    base_fare
  FROM rides)"""


def hash_hex(key: str, seed: int = 42) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|{seed}')"


def split(key: str, seed: int = 42) -> str:
    bucket = f"CAST('0x' || substr({hash_hex(key, seed)}, 1, 8) AS BIGINT) % 100"
    return f"CASE WHEN {bucket} < 20 THEN 'test' ELSE 'train' END"


def raw(field: str, *changes: tuple[int, str | None]) -> str:
    """A request field as text, with other texts (or none) at multiples of some numbers."""
    cases = "".join(f" WHEN ride_id % {n} = 0 THEN {'NULL' if t is None else t}" for n, t in changes)
    return f"CASE{cases} ELSE CAST({field} AS VARCHAR) END" if changes else f"CAST({field} AS VARCHAR)"


RAW = {
    "hour_of_day": raw("hour_of_day", (7, "'25'")),
    "day_of_week": raw("day_of_week", (29, "'7'")),
    "is_weekend": raw("is_weekend", (23, "'maybe'")),
    "passenger_demand": raw("passenger_demand", (17, None), (37, "'-3'")),
    "driver_availability": raw("driver_availability", (19, "'18.5'")),
    "weather_condition": raw("weather_condition", (11, "'hurricane'"), (47, "'clear' || chr(10)")),
    "temperature": raw("temperature", (43, "'warm'")),
    "visibility_km": raw("visibility_km", (31, "'-1'")),
    "base_fare": raw("base_fare", (13, "'-5.0'"), (41, "'NaN'")),
}
WHOLE = "'[+-]?[0-9]+'"


def check(field: str, right_type: str, in_range: str) -> str:
    """What is wrong with a raw field: its type is read and its range is compared here, in SQL."""
    text = RAW[field]
    kind, good = right_type.replace("@", f"({text})"), in_range.replace("@", f"({text})")
    return (
        f"CASE WHEN ({text}) IS NULL THEN '{field}:missing' WHEN NOT ({kind}) THEN '{field}:type' "
        f"WHEN NOT ({good}) THEN '{field}:range' END"
    )


IS_WHOLE = f"regexp_full_match(@, {WHOLE})"
IS_NUMBER = "TRY_CAST(@ AS DOUBLE) IS NOT NULL"
ERRORS = "concat_ws(',', " + ", ".join(
    [
        check("hour_of_day", IS_WHOLE, "TRY_CAST(@ AS BIGINT) BETWEEN 0 AND 23"),
        check("day_of_week", IS_WHOLE, "TRY_CAST(@ AS BIGINT) BETWEEN 0 AND 6"),
        check("is_weekend", "lower(trim(@)) IN ('true', 'false', 't', 'f', 'yes', 'no', 'y', 'n', '1', '0', 'on', 'off')", "TRUE"),
        check("passenger_demand", IS_WHOLE, "TRY_CAST(@ AS BIGINT) >= 0"),
        check("driver_availability", IS_WHOLE, "TRY_CAST(@ AS BIGINT) >= 0"),
        check("weather_condition", "TRUE", "@ IN ('clear', 'cloudy', 'rain', 'storm', 'snow')"),
        check("temperature", IS_NUMBER, "TRUE"),
        check("visibility_km", IS_NUMBER, "TRY_CAST(@ AS DOUBLE) >= 0 AND NOT isnan(TRY_CAST(@ AS DOUBLE))"),
        check("base_fare", IS_NUMBER, "TRY_CAST(@ AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(@ AS DOUBLE))"),
    ]
) + ")"
VALID = f"({ERRORS}) = ''"

REQUEST_TEXT = (
    f"SELECT ride_id, {RAW['hour_of_day']} AS hour_of_day, {RAW['passenger_demand']} AS passenger_demand, "
    f"{RAW['weather_condition']} AS weather_condition, {RAW['is_weekend']} AS is_weekend FROM rides"
)

PRICED = f"""priced AS (
  SELECT ride_id, base_fare, {clipped(formula())} AS p FROM rides WHERE {VALID})"""
CONFIDENCE = (
    "CASE WHEN p BETWEEN 1.3::DOUBLE AND 2.0::DOUBLE THEN 'medium' "
    "WHEN p < 1.3::DOUBLE OR p > 2.5::DOUBLE THEN 'low' ELSE 'high' END"
)
SCORED = (
    with_(*BASE, PRICED)
    + f"SELECT ride_id, {even('p', 2)} AS price_multiplier, {even('base_fare * p', 2)} AS estimated_price, "
    f"{CONFIDENCE} AS confidence FROM priced"
)

# --- evaluation ------------------------------------------------------------------

PREDICTED = f"""predicted AS (
  SELECT {split("ride_id")} AS split, price_multiplier AS y, m.model_name,
    CASE m.model_name WHEN 'formula' THEN {clipped(formula())}
      WHEN 'no_weather' THEN {clipped(formula("0"))} ELSE 1.5::DOUBLE END AS p
  FROM rides, (VALUES ('formula'), ('no_weather'), ('constant')) AS m(model_name))"""


def metrics(by: str) -> str:
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {keys}sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, "
        f"1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM predicted{group}"
    )


METRICS = f"metrics AS ({metrics('model_name, split')})"
COMPARISON = """comparison AS (
  SELECT model_name, max(rmse) FILTER (split = 'train') AS train_rmse,
    max(r2) FILTER (split = 'train') AS train_r2, max(rmse) FILTER (split = 'test') AS test_rmse,
    max(r2) FILTER (split = 'test') AS test_r2, max(mae) FILTER (split = 'test') AS test_mae
  FROM metrics GROUP BY model_name)"""

# --- learners with one feature: closed forms ---------------------------------------

ONE = f"one AS (SELECT {split('ride_id')} AS split, price_multiplier AS y, {RATIO} AS x, is_weekend FROM rides)"
LINES = """lines AS (
  SELECT model_name, sxy / (sxx + alpha) AS slope, my - sxy / (sxx + alpha) * mx AS intercept
  FROM (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(y, x) * count(*) AS sxy, var_pop(x) * count(*) AS sxx
        FROM one WHERE split = 'train'),
       (VALUES ('linear_regression', 0.0::DOUBLE), ('ridge_regression', 50.0::DOUBLE)) AS m(model_name, alpha))"""
LINE_PREDICTED = "predicted AS (SELECT model_name, split, y, intercept + slope * x AS p FROM one, lines)"
BEST_LINE = """best_line AS (
  SELECT * FROM lines JOIN comparison USING (model_name) ORDER BY test_rmse, model_name LIMIT 1)"""
ONE_LINES = [*BASE, ONE, LINES, LINE_PREDICTED, METRICS, COMPARISON, BEST_LINE]
ONE_METRICS = f"SELECT model_name, split, {r6('rmse', 'rmse')}, {r6('mae', 'mae')}, {r6('r2', 'r2')} FROM metrics"


def one_line(name: str) -> str:
    return with_(*ONE_LINES) + f"{ONE_METRICS} WHERE model_name = '{name}'"


def one_tree(name: str) -> str:
    """A tree of one split on a truth value gives the mean of each side."""
    means = "means AS (SELECT is_weekend, avg(y) AS p FROM one WHERE split = 'train' GROUP BY is_weekend)"
    scored = f"predicted AS (SELECT '{name}' AS model_name, split, y, p FROM one JOIN means USING (is_weekend))"
    return with_(*BASE, ONE, means, scored, METRICS) + ONE_METRICS


ONE_LOG = (
    with_(*ONE_LINES)
    + """SELECT model_name, 'param' AS kind, key, NULL::DOUBLE AS number, text
FROM (VALUES ('linear_regression', 'model_class', 'LinearRegression'), ('ridge_regression', 'model_class', 'Ridge'),
             ('ridge_regression', 'alpha', '50.0')) AS v(model_name, key, text)
UNION ALL
SELECT model_name, 'metric', split || '_' || metric, round(value, 6) + 0.0, NULL
FROM metrics UNPIVOT (value FOR metric IN (rmse, mae, r2))"""
)
ONE_SCORED = (
    with_(
        *ONE_LINES,
        f"priced AS (SELECT ride_id, base_fare, {clipped(f'intercept + slope * ({RATIO})')} AS p "
        f"FROM rides, best_line WHERE {VALID})",
    )
    + f"SELECT ride_id, {even('p', 2)} AS price_multiplier, {even('base_fare * p', 2)} AS estimated_price, "
    f"{CONFIDENCE} AS confidence FROM priced"
)
ONE_CARD = (
    with_(*ONE_LINES)
    + "SELECT model_name, CASE model_name WHEN 'linear_regression' THEN 'LinearRegression' ELSE 'Ridge' END AS model_type, "
    f"'demand_supply_ratio' AS features, {r6('test_rmse', 'test_rmse')}, {r6('test_r2', 'test_r2')}, "
    f"{r6('test_mae', 'test_mae')} FROM best_line"
)

# --- drift -----------------------------------------------------------------------

COLUMNS = DRIFT_FEATURES
AS_DOUBLE = ", ".join(
    f"CAST({'CAST(is_weekend AS INTEGER)' if c == 'is_weekend' else c} AS DOUBLE) AS {c}" for c in COLUMNS
)


def long(source: str, keys: str) -> str:
    return (
        f"SELECT {keys}, feature, x FROM (SELECT {keys}, {AS_DOUBLE} FROM {source}) "
        f"UNPIVOT (x FOR feature IN ({', '.join(COLUMNS)}))"
    )


TAGGED = f"tagged AS (SELECT *, \"timestamp\" < TIMESTAMP '{BASELINE_END}' AS is_ref FROM encoded)"
PAIRS = f"""pairs AS (
  SELECT feature, x, count(*) FILTER (is_ref) AS n_ref, count(*) FILTER (NOT is_ref) AS n_cur
  FROM ({long("tagged", "is_ref")}) GROUP BY feature, x)"""


def drift_parts(keys: str = "") -> list[str]:
    """CTEs from ``pairs`` to ``stats``: every statistic per (keys, feature)."""
    k = f"{keys}, " if keys else ""
    on = f"USING ({k}feature)"
    return [
        f"""prof AS (
  SELECT {k}feature, CAST(sum(n_ref) AS DOUBLE) AS ref_rows, CAST(sum(n_cur) AS DOUBLE) AS cur_rows,
    count(*) AS distinct_values, sum(x * n_ref) / nullif(sum(n_ref), 0) AS ref_mean
  FROM pairs GROUP BY {k}feature)""",
        f"""cdf AS (
  SELECT {k}feature, n_ref, ref_rows, x - ref_mean AS dev,
    abs(sum(n_ref) OVER w / ref_rows - sum(n_cur) OVER w / cur_rows) AS d,
    coalesce(lead(x) OVER (PARTITION BY {k}feature ORDER BY x) - x, 0.0) AS gap
  FROM pairs JOIN prof {on}
  WINDOW w AS (PARTITION BY {k}feature ORDER BY x))""",
        f"""ordered AS (
  SELECT {k}feature, max(d) AS ks,
    sum(d * gap) / greatest(sqrt(sum(n_ref * dev * dev) / max(ref_rows)), 0.001) AS wasserstein
  FROM cdf GROUP BY {k}feature)""",
        f"""shares AS (
  SELECT {k}feature, x, n_ref, n_cur, ref_rows, cur_rows, n_ref / ref_rows AS p, n_cur / cur_rows AS q
  FROM pairs JOIN prof {on})""",
        f"""categories AS (
  SELECT {k}feature,
    sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS jensen_shannon,
    sum(CASE WHEN p > 0 THEN (n_cur - p * cur_rows) * (n_cur - p * cur_rows) / (p * cur_rows)
      WHEN n_cur > 0 THEN 'inf'::DOUBLE ELSE 0 END) AS chi_square,
    arg_min(q - p, x) / nullif(sqrt(arg_min((n_ref + n_cur) / (ref_rows + cur_rows), x)
      * (1 - arg_min((n_ref + n_cur) / (ref_rows + cur_rows), x))
      * (1 / max(ref_rows) + 1 / max(cur_rows))), 0) AS z
  FROM shares GROUP BY {k}feature)""",
        f"""stats AS (
  SELECT *, CASE WHEN distinct_values <= 5 THEN 'jensen_shannon' ELSE 'wasserstein' END AS large_test,
    CASE WHEN distinct_values <= 2 THEN 'z' WHEN distinct_values <= 5 THEN 'chi_square' ELSE 'ks' END
      AS small_test,
    CASE WHEN distinct_values <= 5 THEN jensen_shannon ELSE wasserstein END AS score
  FROM prof JOIN ordered {on} JOIN categories {on})""",
    ]


POSITIONS = "positions(feature, position) AS (VALUES " + ", ".join(
    f"('{c}', {i})" for i, c in enumerate(COLUMNS)
) + ")"
RIDE_DRIFT = [*BASE, FEATURES, ENCODED, TAGGED, PAIRS, *drift_parts(), POSITIONS]
SIZES = """sizes AS (
  SELECT count(*) FILTER (is_ref) AS reference_rows, count(*) FILTER (NOT is_ref) AS current_rows FROM tagged)"""
SUMMARY = """summary AS (
  SELECT count(*) FILTER (score >= 0.1) AS n, count(*) AS features,
    coalesce(string_agg(feature, ',' ORDER BY position) FILTER (score >= 0.1), '') AS names
  FROM stats JOIN positions USING (feature))"""

LINE_PAIRS_NUMERIC = (
    "SELECT early, feature, x, NULL AS v FROM (SELECT early, "
    + ", ".join(LINE_NUMBERS)
    + f" FROM items) UNPIVOT (x FOR feature IN ({', '.join(LINE_NUMBERS)}))"
)
LINE_PAIRS_TEXT = (
    "SELECT early, feature, NULL AS x, v FROM (SELECT early, l_returnflag, l_linestatus FROM items) "
    "UNPIVOT (v FOR feature IN (l_returnflag, l_linestatus))"
)

# --- what-if -----------------------------------------------------------------------

SPIKES = {
    "demand_mild": (1.5, 0.8, 2.0),
    "demand_moderate": (2.5, 0.5, 5.0),
    "demand_severe": (4.0, 0.3, 10.0),
}


def spiked(name: str, source: str = "rides") -> str:
    """Rides under one scenario, raw columns only."""
    demand, drivers, temperature = "passenger_demand", "driver_availability", "temperature"
    weather = "weather_condition"
    if name in SPIKES:
        up, down, drop = SPIKES[name]
        demand = f"CAST(trunc(greatest(passenger_demand * {up}::DOUBLE, 1.0)) AS BIGINT) AS passenger_demand"
        drivers = f"CAST(trunc(greatest(driver_availability * {down}::DOUBLE, 1.0)) AS BIGINT) AS driver_availability"
        temperature = f"temperature - {drop}::DOUBLE AS temperature"
    if name == "weather_storm":
        weather = "'storm' AS weather_condition"
    return (
        f"SELECT ride_id, hour_of_day, day_of_week, is_weekend, {demand}, {drivers}, {weather}, "
        f"{temperature}, visibility_km, base_fare FROM {source}"
    )


SCENARIOS = ["control", *SPIKES, "weather_storm"]


def scenario_drift(parts: dict[str, str], prelude: list[str]) -> list[str]:
    """CTEs up to ``stats`` keyed by scenario; ``parts`` maps each scenario to its raw rows."""
    union = " UNION ALL ".join(f"SELECT '{n}' AS scenario, * FROM ({sql})" for n, sql in parts.items())
    base = "SELECT 'base' AS scenario, * FROM (" + spiked("control") + ")"
    names = ", ".join(f"('{n}')" for n in parts)
    return [
        *BASE,
        *prelude,
        f"variants AS ({union} UNION ALL {base})",
        f"varied AS (SELECT *, {ENGINEER}, {ONE_HOT} FROM variants)",
        f"raw_counts AS (SELECT scenario, feature, x, count(*) AS n FROM ({long('varied', 'scenario')}) "
        "GROUP BY ALL)",
        f"names(scenario) AS (VALUES {names})",
        "pairs AS (SELECT scenario, feature, x, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM ("
        "SELECT scenario, feature, x, 0 AS n_ref, n AS n_cur FROM raw_counts WHERE scenario <> 'base' "
        "UNION ALL SELECT names.scenario, feature, x, n AS n_ref, 0 AS n_cur FROM raw_counts, names "
        "WHERE raw_counts.scenario = 'base') GROUP BY ALL)",
        *drift_parts("scenario"),
        POSITIONS,
    ]


WIF = scenario_drift({n: spiked(n) for n in SCENARIOS}, [])
WIF_ROWS = "(SELECT count(*) FROM rides)"
SAMPLE = f"sampled AS (SELECT * FROM rides ORDER BY {hash_hex('ride_id')}, ride_id LIMIT 2000)"


def whatif(name: str) -> str:
    return with_(*BASE, f"variant AS ({spiked(name)})") + (
        f"SELECT {', '.join(WHATIF_COLUMNS)} FROM (SELECT *, {ENGINEER} FROM variant)"
    )


# --- streaming ---------------------------------------------------------------------

STREAM_LONG = " UNION ALL ".join(
    [
        f"SELECT w, '{c}' AS feature, floor({c} / {w}::DOUBLE) * {w}::DOUBLE AS x, NULL AS v FROM timed"
        for c, w in STREAM_WIDTHS.items()
    ]
    + ["SELECT w, 'weather_condition', NULL, weather_condition FROM timed"]
)
TIMED = """timed AS (SELECT *, date_trunc('day', "timestamp") AS w FROM event_rides)"""
CLOSED = """closed AS (
  SELECT DISTINCT w FROM timed WHERE w + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM timed) - INTERVAL 1 HOUR)"""
BINS = f"bins AS (SELECT w, feature, x, v, count(*) AS n FROM ({STREAM_LONG}) GROUP BY ALL)"
STREAM_BASE = f"""base_bins AS (
  SELECT feature, x, v, count(*) AS n FROM (
    {STREAM_LONG.replace("FROM timed", f"FROM timed WHERE " + chr(34) + "timestamp" + chr(34) + f" < TIMESTAMP '{BASELINE_END}'")})
  GROUP BY ALL)"""
STREAM_PAIRS = """mixed AS (
  SELECT w, feature, x, v, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM (
    SELECT w, feature, x, v, 0 AS n_ref, n AS n_cur FROM bins WHERE w IN (SELECT w FROM closed)
    UNION ALL SELECT w, feature, x, v, n, 0 FROM base_bins, closed) GROUP BY ALL)"""


def generic_stats(keys: str) -> list[str]:
    """Distances for pairs that may be text: from ``mixed`` to ``scores``."""
    k = f"{keys}, " if keys else ""
    on = f"USING ({k}feature)"
    return [
        f"""prof AS (
  SELECT {k}feature, CAST(sum(n_ref) AS DOUBLE) AS ref_rows, CAST(sum(n_cur) AS DOUBLE) AS cur_rows,
    CASE WHEN bool_or(v IS NOT NULL) OR count(*) <= 5 THEN 'jensen_shannon' ELSE 'wasserstein' END AS test,
    sum(x * n_ref) / nullif(sum(n_ref), 0) AS ref_mean
  FROM mixed GROUP BY {k}feature)""",
        f"""cdf AS (
  SELECT {k}feature, test, n_ref, ref_rows, x - ref_mean AS dev, n_ref / ref_rows AS p, n_cur / cur_rows AS q,
    abs(sum(n_ref) OVER w1 / ref_rows - sum(n_cur) OVER w1 / cur_rows) AS d,
    coalesce(lead(x) OVER w1 - x, 0.0) AS gap
  FROM mixed JOIN prof {on}
  WINDOW w1 AS (PARTITION BY {k}feature ORDER BY x, v))""",
        f"""scores AS (
  SELECT {k}feature, test, CASE WHEN test = 'wasserstein'
    THEN sum(d * gap) / greatest(sqrt(sum(n_ref * dev * dev) / max(ref_rows)), 0.001)
    ELSE sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) END AS score
  FROM cdf GROUP BY {k}feature, test)""",
    ]


def describe(source: str, columns: list[str]) -> str:
    rows = [
        f"SELECT '{c}' AS column_name, count({c}) AS count, {even(f'avg({c})', 3)} AS mean, "
        f"{even(f'stddev_samp({c})', 3)} AS std, {even(f'min({c})', 3)} AS min, "
        + ", ".join(f"{even(f'quantile_cont({c}, 0.{q})', 3)} AS p{q}" for q in (25, 50, 75))
        + f", {even(f'max({c})', 3)} AS max FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(rows)


def rule(name: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS rule, count(*) AS row_count, "
        f"count(*) FILTER (NOT coalesce({condition}, false)) AS violations, "
        f"count(*) FILTER (NOT coalesce({condition}, false)) = 0 AS passed FROM rides"
    )


RULES = " UNION ALL ".join(
    rule(n, c)
    for n, c in {
        "price_multiplier_range": "price_multiplier BETWEEN 1 AND 3",
        "hour_of_day_range": "hour_of_day BETWEEN 0 AND 23",
        "day_of_week_range": "day_of_week BETWEEN 0 AND 6",
        "temperature_range": "temperature BETWEEN -30 AND 50",
        "visibility_km_positive": "visibility_km > 0",
        "base_fare_positive": "base_fare > 0",
        "passenger_demand_positive": "passenger_demand > 0",
        "driver_availability_positive": "driver_availability > 0",
        "weather_condition_domain": "weather_condition IN ('clear', 'cloudy', 'rain', 'storm', 'snow')",
        "no_missing": "num_nulls = 0",
        "weekend_matches_weekday": "is_weekend = (day_of_week >= 5)",
    }.items()
).replace(
    "num_nulls = 0",
    " AND ".join(
        f"{c} IS NOT NULL"
        for c in ["ride_id", '"timestamp"', *BASE_FEATURES, "weather_condition", "price_multiplier"]
    ),
)

ALL_FEATURES = [*BASE_FEATURES, *[f"weather_condition_{w}" for w in WEATHERS], *ENGINEERED]
NUMERIC = [
    f"CAST({'CAST(is_weekend AS INTEGER)' if c == 'is_weekend' else c} AS DOUBLE) AS {c}" for c in ALL_FEATURES
]
MODEL_ROWS = f"""model_rows AS (
  SELECT ride_id, {split("ride_id")} AS split, price_multiplier, {", ".join(NUMERIC)} FROM encoded)"""
SCALED = ", ".join(
    r6(
        f"({c} - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 "
        f"ELSE stddev_pop({c}) END FROM train)",
        c,
    )
    for c in ALL_FEATURES
)
TRAIN = "train AS (SELECT * FROM model_rows WHERE split = 'train')"


def median_fill(c: str, source: str) -> str:
    return r6(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM {source}))", c)


def mode_fill(source: str) -> str:
    return (
        "coalesce(weather_condition, (SELECT weather_condition FROM "
        f"(SELECT weather_condition, count(*) AS n FROM {source} WHERE weather_condition IS NOT NULL "
        "GROUP BY 1 ORDER BY n DESC, weather_condition LIMIT 1))) AS weather_condition"
    )


RIDE_COLUMNS = (
    'SELECT ride_id, "timestamp", hour_of_day, day_of_week, is_weekend, passenger_demand, '
    "driver_availability, weather_condition, temperature, visibility_km, base_fare, price_multiplier FROM rides"
)
TO_R6 = {c: r6(c, c) for c in ["hour_sin", "hour_cos"]}

# p-values by series. erf is a sum of positive terms; with few categories the chi-square
# tails of two to four degrees of freedom are closed forms.
ERF = (
    "(1.1283791670955126::DOUBLE * exp(-(u * u)) * (SELECT sum(exp(2 * k * ln(2.0::DOUBLE) + (2 * k + 1) * ln(greatest(u, 1e-300)) "
    "- lgamma(2.0::DOUBLE * k + 2) + lgamma(k + 1.0::DOUBLE))) FROM range(400) t(k)))"
)
P_VALUES = f"""tested AS (
  SELECT *, CASE small_test WHEN 'ks' THEN ks WHEN 'chi_square' THEN chi_square ELSE coalesce(z, 0) END AS statistic,
    sqrt(ref_rows * cur_rows / (ref_rows + cur_rows)) * ks AS lam,
    CASE small_test WHEN 'z' THEN abs(coalesce(z, 0)) / sqrt(2.0::DOUBLE) ELSE sqrt(chi_square / 2) END AS u
  FROM stats),
tails AS (
  SELECT *, CASE WHEN u > 6 THEN 0.0 ELSE 1.0 - {ERF} END AS erfc,
    (SELECT sum((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0::DOUBLE * (k * lam) * (k * lam))) FROM range(1, 101) t(k)) AS ks_tail
  FROM tested),
p_values AS (
  SELECT *, CASE small_test
    WHEN 'ks' THEN CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(ks_tail, 0.0), 1.0) END
    WHEN 'z' THEN erfc
    ELSE CASE distinct_values
      WHEN 3 THEN exp(-chi_square / 2)
      WHEN 4 THEN erfc + sqrt(2 * chi_square / pi()) * exp(-chi_square / 2)
      ELSE exp(-chi_square / 2) * (1 + chi_square / 2) END END AS p
  FROM tails)"""

ORACLES: dict[str, str] = {
    "src_rides": with_(*BASE) + RIDE_COLUMNS,
    "src_csv_roundtrip": with_(*BASE) + RIDE_COLUMNS,
    "src_features_roundtrip": with_(*BASE, FEATURES)
    + f"SELECT ride_id, {split('ride_id')} AS split, passenger_demand, demand_supply_ratio, is_rush_hour, is_night "
    "FROM features",
    "src_json_requests": with_(*BASE) + REQUEST_TEXT,
    "jsn_requests": with_(*BASE) + REQUEST_TEXT,
    "prj_features": with_(*BASE)
    + "SELECT hour_of_day, day_of_week, is_weekend, passenger_demand, driver_availability, weather_condition, "
    "temperature, visibility_km, base_fare, price_multiplier AS label FROM rides",
    "prj_numeric": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax FROM lineitem",
    "prj_categorical": "SELECT o_orderstatus, o_orderpriority FROM orders",
    "flt_masks": with_(*BASE)
    + f"SELECT ride_id, hour_of_day, day_of_week FROM rides WHERE {RUSH} = 1 AND is_weekend AND {NIGHT} = 0",
    "flt_valid": with_(*BASE)
    + "SELECT ride_id, hour_of_day, day_of_week, is_weekend, passenger_demand, driver_availability, "
    f"weather_condition, temperature, visibility_km, base_fare FROM rides WHERE {VALID}",
    "flt_quarantine": with_(*BASE)
    + "SELECT ride_id, CASE WHEN ride_id % 7 = 0 THEN '25' ELSE CAST(hour_of_day AS VARCHAR) END AS hour_of_day, "
    f"{ERRORS} AS errors FROM rides WHERE NOT ({VALID})",
    "str_weather_match": with_(*BASE)
    + "SELECT ride_id, ride_id % 11 <> 0 AND weather_condition IN ('clear', 'cloudy', 'rain', 'storm', 'snow') "
    "AS matches FROM rides",
    "str_label_score": with_(*BASE)
    + "SELECT ride_id, CASE WHEN ride_id % 5 <> 0 THEN CAST((ride_id % 3) || '.' || "
    "lpad(CAST(passenger_demand % 100 AS VARCHAR), 2, '0') AS DOUBLE) END AS score FROM rides",
    "cln_null_profile": with_(*BASE, GAPPY)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing_count, "
        f"count(*) > count({c}) AS has_missing FROM gappy"
        for c in ["ride_id", "temperature", "passenger_demand", "weather_condition", "base_fare"]
    ),
    "cln_impute_median": with_(*BASE, GAPPY)
    + f"SELECT ride_id, {median_fill('temperature', 'gappy')}, {median_fill('passenger_demand', 'gappy')}, "
    "base_fare FROM gappy",
    "cln_impute_mode": with_(*BASE, GAPPY) + f"SELECT ride_id, {mode_fill('gappy')} FROM gappy",
    "cln_fit_train": with_(
        *BASE,
        GAPPY,
        f"parts AS (SELECT *, {split('ride_id')} AS split FROM gappy)",
        "learn AS (SELECT * FROM parts WHERE split = 'train')",
    )
    + f"SELECT ride_id, split, {median_fill('temperature', 'learn')}, {median_fill('passenger_demand', 'learn')}, "
    f"{mode_fill('learn')}, base_fare FROM parts",
    "agg_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'median({c})', 'median')} FROM lineitem" for c in LINE_NUMBERS
    ),
    "agg_modes": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT {c} FROM (SELECT {c}, count(*) AS n FROM orders GROUP BY 1 "
        f"ORDER BY n DESC, {c} LIMIT 1)) AS mode_value"
        for c in ["o_orderstatus", "o_orderpriority"]
    ),
    "enc_categories": "SELECT DISTINCT 'l_returnflag' AS column_name, l_returnflag AS category FROM lineitem "
    "UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem",
    "enc_onehot": with_(*BASE) + f"SELECT ride_id, {ONE_HOT} FROM rides",
    "enc_onehot_unknown": "SELECT o_orderkey, o_orderstatus, "
    + ", ".join(
        f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "
        f"o_orderpriority_{v.lower().replace(' ', '_').replace('-', '_')}"
        for v in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    )
    + " FROM orders",
    "enc_severity_from_onehot": with_(*BASE)
    + f"SELECT ride_id, CAST({SEVERITY} AS INTEGER) AS weather_severity_score FROM rides",
    "scl_fit": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'std')} FROM lineitem"
        for c in LINE_NUMBERS
    ),
    "scl_transform": "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        r6(f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)", c)
        for c in LINE_NUMBERS
    )
    + " FROM lineitem",
    "scl_train_only": with_(*BASE, FEATURES, ENCODED, MODEL_ROWS, TRAIN)
    + "SELECT ride_id, split, "
    + ", ".join(
        r6(f"({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train)", c)
        for c in ["temperature", "visibility_km", "base_fare"]
    )
    + " FROM model_rows",
    "spl_hash": f"SELECT o_orderkey, o_totalprice, {split('o_orderkey')} AS split FROM orders",
    "spl_exact": "SELECT o_orderkey, o_totalprice, CASE WHEN row_number() OVER "
    f"(ORDER BY {hash_hex('o_orderkey')}, o_orderkey) <= (SELECT ceil(0.2::DOUBLE * count(*)) FROM orders) "
    "THEN 'test' ELSE 'train' END AS split FROM orders",
    "smp_exact": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_hex('o_orderkey')}, o_orderkey "
    "LIMIT 1000",
    "smp_head": with_(*BASE) + RIDE_COLUMNS + " ORDER BY ride_id LIMIT 5",
    "set_union_splits": with_(*BASE) + f"SELECT ride_id, base_fare, {split('ride_id')} AS split FROM rides",
    "feat_ratio": with_(*BASE) + f"SELECT ride_id, {RATIO} AS demand_supply_ratio FROM rides",
    "feat_rush": with_(*BASE) + f"SELECT ride_id, CAST({RUSH} AS INTEGER) AS is_rush_hour FROM rides",
    "feat_severity": with_(*BASE, GAPPY)
    + f"SELECT ride_id, CAST({SEVERITY} AS INTEGER) AS weather_severity_score FROM gappy",
    "feat_cyclical": with_(*BASE, FEATURES)
    + f"SELECT ride_id, {TO_R6['hour_sin']}, {TO_R6['hour_cos']} FROM features",
    "feat_night": with_(*BASE) + f"SELECT ride_id, CAST({NIGHT} AS INTEGER) AS is_night FROM rides",
    "feat_interactions": with_(*BASE, FEATURES)
    + "SELECT ride_id, demand_weather_interaction, fare_per_driver FROM features",
    "feat_calendar": "SELECT o_orderkey, CAST(hour(o_orderdate) AS INTEGER) AS hour_of_day, "
    "CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(month(o_orderdate) AS INTEGER) AS month, "
    "isodow(o_orderdate) >= 6 AS is_weekend FROM orders",
    "feat_clip_round_cast": "SELECT o_orderkey, CASE WHEN a IS NOT NULL THEN least(greatest(a, 20.0::DOUBLE), "
    "150.0::DOUBLE) END AS clipped, CASE WHEN a IS NOT NULL THEN greatest(a, 100.0::DOUBLE) END AS clipped_low, "
    f"{even('o_totalprice / 7.0::DOUBLE', 2)} AS rounded, "
    "CAST(trunc(o_totalprice / 7.0::DOUBLE - 10000.0::DOUBLE) AS BIGINT) AS truncated FROM (SELECT *, "
    "CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 1000.0::DOUBLE END AS a FROM orders)",
    "feat_lookup": "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 "
    "WHEN '3-MEDIUM' THEN 3 ELSE 9 END AS priority_rank FROM orders",
    "feat_all": with_(*BASE, FEATURES)
    + f"SELECT * REPLACE ({TO_R6['hour_sin']}, {TO_R6['hour_cos']}) FROM features",
    "feat_prepared": with_(*BASE, FEATURES, ENCODED, MODEL_ROWS, TRAIN)
    + f"SELECT ride_id, split, price_multiplier, {SCALED} FROM model_rows",
    "fml_price": with_(*BASE) + f"SELECT ride_id, {clipped(formula())} AS multiplier FROM rides",
    "fml_fare": with_(*BASE)
    + "SELECT ride_id, "
    + r6("least(greatest(5.0 + 2.0 * sin(2 * pi() * hour_of_day / 24), 3.0), 12.0)", "cyclic_fare")
    + " FROM rides",
    "agg_describe": describe("lineitem", LINE_NUMBERS),
    "agg_describe_target": with_(*BASE) + describe("rides", ["price_multiplier"]),
    "agg_std": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'stddev_samp({c})', 'std')} FROM lineitem" for c in LINE_NUMBERS
    ),
    "agg_dq_rules": with_(*BASE) + RULES,
    "agg_domain": with_(*BASE, f"requests AS ({REQUEST_TEXT})")
    + "SELECT weather_condition AS value, count(*) AS row_count, "
    "weather_condition IN ('clear', 'cloudy', 'rain', 'storm', 'snow') AS in_domain FROM requests GROUP BY 1",
    "agg_outside_domain": "SELECT o_orderpriority AS value, count(*) AS row_count FROM orders "
    "WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1",
    "eva_metrics": with_(*BASE, PREDICTED)
    + f"SELECT {r6('rmse', 'rmse')}, {r6('mae', 'mae')}, {r6('r2', 'r2')} FROM "
    f"({metrics('').replace('FROM predicted', 'FROM predicted WHERE model_name = ' + chr(39) + 'formula' + chr(39))})",
    "eva_splits": with_(*BASE, PREDICTED, METRICS)
    + f"SELECT model_name, split, {r6('rmse', 'rmse')}, {r6('mae', 'mae')}, {r6('r2', 'r2')} FROM metrics",
    "eva_compare": with_(*BASE, PREDICTED, METRICS, COMPARISON)
    + "SELECT model_name, "
    + ", ".join(r6(c, c) for c in ["train_rmse", "train_r2", "test_rmse", "test_r2", "test_mae"])
    + " FROM comparison",
    "eva_best": with_(*BASE, PREDICTED, METRICS, COMPARISON)
    + "SELECT model_name AS best_model, "
    + ", ".join(r6(c, c) for c in ["test_rmse", "test_r2", "test_mae"])
    + " FROM comparison ORDER BY comparison.test_rmse, model_name LIMIT 1",
    "eva_run_log": with_(*BASE, PREDICTED, METRICS)
    + " UNION ALL ".join(
        f"SELECT model_name, split || '_{m}' AS key, {r6(m, 'value')} FROM metrics" for m in ["rmse", "mae", "r2"]
    ),
    "sco_batch": SCORED,
    "sco_confidence": f"SELECT l_orderkey, l_linenumber, q AS p, {CONFIDENCE} AS confidence FROM "
    "(SELECT *, least(greatest(q, 1.0::DOUBLE), 3.0::DOUBLE) AS p FROM (SELECT l_orderkey, l_linenumber, "
    "l_quantity / 20.0::DOUBLE + 0.8::DOUBLE AS q FROM lineitem))",
    "sco_state": with_(*BASE, FEATURES, ENCODED, MODEL_ROWS, TRAIN)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'std')} FROM train"
        for c in ALL_FEATURES
    ),
    "drf_route": with_(*RIDE_DRIFT)
    + "SELECT feature, CAST(ref_rows AS BIGINT) AS ref_rows, CAST(cur_rows AS BIGINT) AS cur_rows, "
    "distinct_values, large_test AS test, small_test FROM stats",
    "agg_quantiles_narrow": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS share, "
        f"round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        for p in (0.01, 0.25, 0.5, 0.9)
    ),
    "spl_exact_dup": """
SELECT 'test' AS split, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n FROM lineitem
UNION ALL
SELECT 'train', count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) FROM lineitem
""",
    "smp_exact_null": """
WITH d AS (
  SELECT CASE WHEN l_linenumber = 7 THEN l_orderkey END AS k,
         md5(coalesce(CAST(CASE WHEN l_linenumber = 7 THEN l_orderkey END AS VARCHAR), chr(0)) || '|42') AS h
  FROM lineitem)
SELECT CAST(5000 AS BIGINT) AS n, count(k) AS with_key
FROM (SELECT k FROM d ORDER BY h LIMIT 5000)
""",
    "drf_wasserstein": with_(*RIDE_DRIFT)
    + f"SELECT feature, {r6('wasserstein', 'score')} FROM stats WHERE distinct_values > 5",
    "drf_wasserstein_bucketed": with_(*RIDE_DRIFT)
    + f"SELECT feature, {r6('wasserstein', 'score')} FROM stats WHERE distinct_values > 5",
    "drf_ks": with_(*RIDE_DRIFT) + f"SELECT feature, {r6('ks', 'ks')} FROM stats WHERE distinct_values > 5",
    "drf_js": with_(*RIDE_DRIFT)
    + f"SELECT feature, {r6('jensen_shannon', 'score')} FROM stats WHERE distinct_values <= 5",
    "drf_category_tests": with_(*RIDE_DRIFT)
    + f"SELECT feature, {r6('chi_square', 'chi_square')}, {r6('coalesce(z, 0)', 'z')} FROM stats "
    "WHERE distinct_values <= 5",
    "drf_report": with_(*RIDE_DRIFT, SIZES)
    + f"SELECT CAST(position AS INTEGER) AS position, feature, large_test AS test, {r6('score', 'statistic')}, "
    f"{r6('score', 'score')}, 0.1::DOUBLE AS threshold, score >= 0.1 AS drift_detected, reference_rows, "
    "current_rows FROM stats JOIN positions USING (feature), sizes",
    "drf_small": with_(*RIDE_DRIFT)
    + "SELECT feature, small_test AS test, "
    + r6(
        "CASE small_test WHEN 'ks' THEN ks WHEN 'chi_square' THEN chi_square ELSE coalesce(z, 0) END", "statistic"
    )
    + " FROM stats",
    "drf_small_p": with_(*RIDE_DRIFT, SIZES, P_VALUES)
    + f"SELECT CAST(position AS INTEGER) AS position, feature, small_test AS test, {r6('statistic', 'statistic')}, "
    f"{r6('p', 'score')}, 0.05::DOUBLE AS threshold, p < 0.05 AS drift_detected, reference_rows, current_rows "
    "FROM p_values JOIN positions USING (feature), sizes",
    "drf_summary": with_(*RIDE_DRIFT, SIZES, SUMMARY)
    + "SELECT reference_rows, current_rows, n > 0 AS dataset_drift, n AS n_drifted_features, "
    "names AS drifted_features FROM summary, sizes",
    "drf_policies": with_(*RIDE_DRIFT, SUMMARY)
    + "SELECT 'any' AS policy, n AS n_drifted_features, n > 0 AS dataset_drift FROM summary "
    "UNION ALL SELECT 'min_features', n, n >= 3 FROM summary "
    "UNION ALL SELECT 'share', n, n >= 0.5 * features FROM summary",
    "drf_document": with_(*RIDE_DRIFT)
    + f"SELECT feature, score >= 0.1 AS drift_detected, {r6('score', 'score')} FROM stats "
    "WHERE feature IN ('temperature', 'passenger_demand') "
    "UNION ALL SELECT 'no_such_column', false, 0.0::DOUBLE",
    "drf_sample": with_(*scenario_drift({"demand_mild": spiked("demand_mild", "sampled")}, [SAMPLE]))
    + f"SELECT feature, large_test AS test, {r6('score', 'score')}, (SELECT count(*) FROM sampled) "
    "AS current_rows, score >= 0.1 AS drift_detected FROM stats",
    "drf_lineitem": with_(
        "items AS (SELECT *, l_shipdate < TIMESTAMP '1998-06-01' AS early FROM lineitem)",
        f"""mixed AS (
  SELECT feature, x, v, count(*) FILTER (early) AS n_ref, count(*) FILTER (NOT early) AS n_cur
  FROM ({LINE_PAIRS_NUMERIC} UNION ALL {LINE_PAIRS_TEXT}) GROUP BY ALL)""",
        *generic_stats(""),
        "positions(feature, position) AS (VALUES ('l_quantity', 0), ('l_extendedprice', 1), ('l_discount', 2), "
        "('l_tax', 3), ('l_returnflag', 4), ('l_linestatus', 5))",
    )
    + f"SELECT CAST(position AS INTEGER) AS position, feature, test, {r6('score', 'statistic')}, "
    f"{r6('score', 'score')}, 0.1::DOUBLE AS threshold, score >= 0.1 AS drift_detected, "
    "(SELECT count(*) FROM items WHERE early) AS reference_rows, "
    "(SELECT count(*) FROM items WHERE NOT early) AS current_rows FROM scores JOIN positions USING (feature)",
    "wif_compare": with_(*WIF)
    + f"SELECT scenario, feature, large_test AS test, {r6('score', 'score')}, score >= 0.1 AS drift_detected "
    "FROM stats",
    "wif_summary": with_(*WIF)
    + f"SELECT scenario, {WIF_ROWS} AS reference_rows, {WIF_ROWS} AS current_rows, "
    "count(*) FILTER (score >= 0.1) > 0 AS dataset_drift, count(*) FILTER (score >= 0.1) AS n_drifted_features, "
    "coalesce(string_agg(feature, ',' ORDER BY position) FILTER (score >= 0.1), '') AS drifted_features "
    "FROM stats JOIN positions USING (feature) GROUP BY scenario",
    "wif_errors": with_(*WIF)
    + "SELECT scenario, count(*) FILTER (score >= 0.1) AS n_drifted_features, false AS failed FROM stats "
    "WHERE scenario IN ('demand_mild', 'control') GROUP BY scenario "
    "UNION ALL SELECT 'catastrophic', NULL, true UNION ALL SELECT 'hail', NULL, true",
    "wif_demand_mild": whatif("demand_mild"),
    "wif_demand_moderate": whatif("demand_moderate"),
    "wif_demand_severe": whatif("demand_severe"),
    "wif_weather": whatif("weather_storm"),
    "stm_score": SCORED,
    "stm_quarantine": with_(*BASE) + f"SELECT ride_id, {ERRORS} AS errors FROM rides WHERE NOT ({VALID})",
    "stm_profile": with_(EVENT_RIDES, TIMED, CLOSED, BINS)
    + "SELECT w AS window_start, feature, x, v, n FROM bins WHERE w IN (SELECT w FROM closed)",
    "stm_drift": with_(EVENT_RIDES, TIMED, CLOSED, BINS, STREAM_BASE, STREAM_PAIRS, *generic_stats("w"))
    + f"SELECT w AS window_start, feature, test, {r6('score', 'score')}, score >= 0.1 AS drift_detected FROM scores",
    "trn_ols_one": one_line("linear_regression"),
    "trn_ridge_one": one_line("ridge_regression"),
    "trn_forest_one": one_tree("RandomForest"),
    "trn_gbt_one": one_tree("GradientBoosting"),
    "trn_gbt_alt_one": one_tree("GradientBoostingFineBins"),
    "trn_compare_one": with_(*ONE_LINES)
    + "SELECT model_name, CASE model_name WHEN 'linear_regression' THEN 'LinearRegression' ELSE 'Ridge' END AS model_class, "
    + ", ".join(r6(c, c) for c in ("train_rmse", "train_r2", "test_rmse", "test_r2", "test_mae"))
    + " FROM comparison",
    "trn_run_log_one": ONE_LOG,
    "sco_model_one": ONE_SCORED,
    "sco_model_card_one": ONE_CARD,
}
ORACLES |= {
    "src_baseline": with_(*BASE, FEATURES)
    + "SELECT ride_id, passenger_demand, demand_supply_ratio, is_rush_hour, is_night FROM features "
    f"WHERE {split('ride_id')} = 'train'",
    # What is read back is what was written.
    "snk_comparison": ORACLES["eva_compare"],
    "snk_best": ORACLES["eva_best"],
    "snk_drift_history": "SELECT run_date, s.* FROM (VALUES ('2024-02-01'), ('2024-02-02')) AS d(run_date), "
    f"({ORACLES['drf_summary']}) AS s",
    "snk_scenarios": ORACLES["wif_summary"],
}
ORACLES |= tree_oracles([*BASE, FEATURES, f"few AS (SELECT *, {split('ride_id')} AS split FROM features)"])

# Four lots; the watermark of a lot is the latest time of the lots before it, less an hour.
LOTS = """lots AS (
  SELECT lot, max("timestamp") AS latest, count(*) AS n FROM (SELECT *, ride_id % 4 AS lot FROM timed) GROUP BY lot),
marks AS (
  SELECT lot, max(latest) OVER (ORDER BY lot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS before,
         max(latest) OVER (ORDER BY lot) - INTERVAL 1 HOUR AS after, sum(n) OVER (ORDER BY lot) AS rows_in
  FROM lots),
judged AS (
  SELECT t.*, lot, "timestamp" IS NULL AS untimed, coalesce(w + INTERVAL 1 DAY <= before, false) AS is_late
  FROM timed t JOIN marks ON lot = ride_id % 4),
last_mark AS (SELECT max(after) AS mark FROM marks)"""
KEPT = f"""kept AS (
  SELECT w, feature, x, v, count(*) AS n FROM ({
    STREAM_LONG.replace("FROM timed", "FROM judged WHERE NOT untimed AND NOT is_late")
  } UNION ALL SELECT w, '_rows', 1.0::DOUBLE, NULL FROM judged WHERE NOT untimed AND NOT is_late)
  WHERE x IS NOT NULL OR v IS NOT NULL GROUP BY ALL)"""
ORACLES |= {
    "stm_late": with_(EVENT_RIDES, TIMED, LOTS)
    + "SELECT ride_id, w AS window_start, CASE WHEN untimed THEN 'no_time' ELSE 'late' END AS reason "
    "FROM judged WHERE untimed OR is_late",
    "stm_windows": with_(EVENT_RIDES, TIMED, LOTS, KEPT)
    + "SELECT w AS window_start, feature, x, v, n, w + INTERVAL 1 DAY <= mark AS closed FROM kept, last_mark",
    "stm_balance": with_(EVENT_RIDES, TIMED, LOTS)
    + """SELECT m.lot AS batch_id, after AS watermark, rows_in::BIGINT AS rows_in,
       (rows_in - late - untimed)::BIGINT AS rows_kept, late::BIGINT AS rows_late, untimed::BIGINT AS rows_untimed
FROM marks m JOIN (
  SELECT lot, sum(count_if(is_late)) OVER (ORDER BY lot) AS late, sum(count_if(untimed)) OVER (ORDER BY lot) AS untimed
  FROM judged GROUP BY lot) s USING (lot)""",
}
ORACLES |= {
    "flt_malformed": with_(*BASE)
    + f"""SELECT ride_id, CASE WHEN ride_id % 12 IN (0, 1, 2, 4, 5, 6, 7, 8) THEN 'document:malformed' ELSE {ERRORS} END AS errors,
       CASE ride_id % 12 WHEN 0 THEN '{{' WHEN 1 THEN '[' WHEN 2 THEN '4' WHEN 4 THEN '{{' WHEN 5 THEN '' WHEN 6 THEN '{{'
         WHEN 7 THEN '{{' WHEN 8 THEN '' END AS begins
FROM rides WHERE ride_id % 12 IN (0, 1, 2, 4, 5, 6, 7, 8) OR NOT ({VALID})""",
    # Of a repeated key the last value counts, so these read like the others.
    "jsn_documents": with_(*BASE) + REQUEST_TEXT + " WHERE ride_id % 12 IN (3, 9, 10, 11)",
    "snk_drift_rerun": f"SELECT run, s.* FROM (VALUES ('007'), ('b')) AS r(run), ({ORACLES['drf_summary']}) AS s",
    "snk_runs": f"SELECT run, s.* FROM (VALUES ('1'), ('2024-02-02')) AS r(run), ({ONE_LOG}) AS s",
}

FARES_UP = spiked("control").replace("base_fare FROM", "base_fare * 1.5::DOUBLE AS base_fare FROM")
# All ways to choose six of the twelve slots, by the bits of a number.
KS_EXACT = """slots AS (
  SELECT hour(ts) // 2 AS slot, count(*)::DOUBLE AS events, count(DISTINCT user_id)::DOUBLE AS users,
         round(avg(value), 0) AS mean_value, (count(*) % 7)::DOUBLE AS odd
  FROM events WHERE ts IS NOT NULL GROUP BY 1),
points AS (
  SELECT *, (row_number() OVER (PARTITION BY feature ORDER BY x, slot) - 1)::INTEGER AS bit
  FROM slots UNPIVOT (x FOR feature IN (events, users, mean_value, odd))),
deals AS (
  SELECT m AS deal FROM range(4096) r(m) WHERE bit_count(m) = 6
  UNION ALL SELECT -1),
dealt AS (
  SELECT deal, feature, x, bit, CASE WHEN deal < 0 THEN slot < 6 ELSE (deal >> bit) & 1 = 1 END AS is_ref FROM points, deals),
gone AS (
  SELECT deal, feature, x, bit,
         sum(CASE WHEN is_ref THEN 1 ELSE -1 END) OVER (PARTITION BY deal, feature ORDER BY x) AS apart
  FROM dealt),
distances AS (SELECT deal, feature, max(abs(apart))::BIGINT AS d FROM gone GROUP BY deal, feature),
compared AS (
  SELECT feature, any_value(o.d) AS d, count(*) FILTER (a.d >= o.d) / count(*) AS p
  FROM distances a JOIN (SELECT feature, d FROM distances WHERE deal < 0) o USING (feature) WHERE deal >= 0 GROUP BY feature)"""
ORACLES |= {
    "wif_isolated": with_(*scenario_drift({"demand_severe": spiked("demand_severe"), "fares_up": FARES_UP, "control": spiked("control")}, []))
    + "SELECT scenario, count(*) FILTER (score >= 0.1) AS n_drifted_features, "
    "coalesce(string_agg(feature, ',' ORDER BY position) FILTER (score >= 0.1), '') AS drifted_features, NULL AS why "
    "FROM stats JOIN positions USING (feature) GROUP BY scenario UNION ALL SELECT 'broken', NULL, '', 'DIVIDE_BY_ZERO'",
    "agg_sketches": "SELECT feature, p::DOUBLE AS p, count(*) AS n, true AS within FROM (SELECT l_quantity::DOUBLE AS l_quantity, "
    "l_extendedprice::DOUBLE AS l_extendedprice, l_discount::DOUBLE AS l_discount FROM lineitem) "
    "UNPIVOT (x FOR feature IN (l_quantity, l_extendedprice, l_discount)), "
    "(VALUES (0.01), (0.1), (0.25), (0.5), (0.75), (0.9), (0.99)) AS shares(p) GROUP BY feature, p",
    "drf_ks_exact": with_(KS_EXACT)
    + f"SELECT feature, 'ks' AS test, {r6('d / 6.0::DOUBLE', 'statistic')}, {r6('p', 'score')}, p < 0.05 AS drift_detected FROM compared",
}
NO_GRADIENT = "SELECT unnest([" + ", ".join(f"'{c}'" for c in [*ALL_FEATURES, "intercept"]) + "]) AS weight, 0.0::DOUBLE AS gradient"
ORACLES |= {
    "trn_ols_gradient": NO_GRADIENT,
    "trn_ridge_gradient": NO_GRADIENT,
    "sco_pipeline_one": with_(*ONE_LINES)
    + f"SELECT ride_id, {r6(f'intercept + slope * ({RATIO})', 'prediction')} FROM rides, best_line WHERE {VALID}",
}
ORACLES["enc_sparse"] = """
WITH known AS (
  SELECT DISTINCT 1 AS o, o_orderpriority AS category FROM orders WHERE o_orderkey % 2 = 1
  UNION ALL SELECT DISTINCT 2, o_custkey::VARCHAR FROM orders WHERE o_orderkey % 2 = 1
  UNION ALL SELECT DISTINCT 3, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1),
places AS (SELECT o, category, row_number() OVER (ORDER BY o, category) - 1 AS place FROM known WHERE category IS NOT NULL)
SELECT o_orderkey, concat_ws(',', p.place, c.place, s.place) AS positions, (SELECT count(*) FROM places) AS size
FROM orders LEFT JOIN places p ON p.o = 1 AND p.category = o_orderpriority
     LEFT JOIN places c ON c.o = 2 AND c.category = o_custkey::VARCHAR
     LEFT JOIN places s ON s.o = 3 AND s.category = o_orderstatus"""
