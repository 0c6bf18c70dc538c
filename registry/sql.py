"""SQL building blocks of the checks, as common table expressions that mirror the stages."""

from __future__ import annotations

# Nothing here comes from the package: columns, limits, tokens and feature names are written out by hand.
NUMERIC = [f"{m}_{f}" for f in "anr" for m in ("qty", "price", "disc", "tax")] + ["target"]
REQUIRED = ["entity", "d", *NUMERIC, "bucket"]
_LIMITS = {50: "Good", 100: "Satisfactory", 200: "Moderate", 300: "Poor", 400: "Very Poor"}
_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
_LAGGED, _CHANGED = ["qty_a", "price_a", "qty_n", "target"], ["qty_a", "price_a", "qty_n", "disc_a", "target"]
_VOLATILE, _BACK = ["qty_a", "price_a", "target"], [1, 3, 7]
_ROLLED = ["mean_3", "mean_7", "mean_14", "std_7", "std_14", "min_7", "max_7"]
CATEGORY_OF = {
    "calendar": [f"{n}_{fn}" for n in ("day_of_week", "month", "day_of_year", "season") for fn in ("sin", "cos")],
    "lag": [f"{c}_lag_{k}" for c in _LAGGED for k in _BACK],
    "rolling": [f"{c}_roll_{w}" for c in _LAGGED for w in _ROLLED],
    "roc": [f"{c}_roc_{k}" for c in _CHANGED for k in _BACK],
    "volatility": [f"{c}_volatility_{w}" for c in _VOLATILE for w in (7, 14)],
}
CONTINUOUS = [n for family in ("lag", "rolling", "roc", "volatility") for n in CATEGORY_OF[family]]
MODEL = [*[f"scaled_{c}" for c in NUMERIC], *CATEGORY_OF["calendar"], *CONTINUOUS]


def r(expr: str, name: str, digits: int = 6) -> str:
    """Rounded value without negative zero."""
    return f"(round({expr}, {digits}) + 0.0) AS {name}"


def day(expr: str, name: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name}"


def band(x: str) -> str:
    cases = " ".join(f"WHEN {x} <= {limit} THEN '{name}'" for limit, name in _LIMITS.items())
    return f"CASE {cases} WHEN {x} IS NOT NULL THEN 'Severe' END"


def _join(items) -> str:
    return ", ".join(items)


_AGG = {"qty": ("sum", "l_quantity"), "price": ("max", "l_extendedprice"), "disc": ("max", "l_discount"), "tax": ("max", "l_tax")}
_CELLS = _join(f"{fn}({c}) FILTER (WHERE l_returnflag = '{f.upper()}') AS {m}_{f}" for f in "anr" for m, (fn, c) in _AGG.items())

PANEL = f"""
keyed AS MATERIALIZED (
  SELECT *, {band('target')} AS bucket FROM (
    SELECT n_name AS entity, CAST(l_shipdate AS DATE) AS d, {_CELLS},
           10 * max(l_quantity) FILTER (WHERE l_linestatus = 'O') AS target, max(n_nationkey) AS nk
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY 1, 2)),
panel AS (SELECT * EXCLUDE (nk) FROM keyed)"""

_TEXT = _join(f"CAST({c} AS VARCHAR) AS {c}" for c in REQUIRED)
RAW = PANEL + f""",
texts AS (SELECT (d - DATE '1970-01-01') * 25 + nk AS code, {_TEXT} FROM keyed),
faulty AS (SELECT * REPLACE (
    CASE WHEN code % 521 = 0 THEN chr(9) || ' ' || entity || '  ' ELSE entity END AS entity,
    CASE WHEN code % 997 = 0 THEN 'bad-date' WHEN code % 991 = 0 THEN '2020-02-30' ELSE d END AS d,
    CASE WHEN code % 499 = 0 THEN 'not_a_number' WHEN code % 503 = 0 THEN '-15.0' ELSE qty_a END AS qty_a,
    CASE WHEN code % 509 = 0 THEN 'NA' ELSE price_n END AS price_n,
    CASE WHEN code % 541 = 0 THEN 'inf' ELSE tax_r END AS tax_r,
    CASE WHEN code % 523 = 0 THEN 'Unknown' ELSE bucket END AS bucket) FROM texts),
raw0 AS (SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE code % 1009 = 0
         UNION ALL SELECT * REPLACE ('1' AS qty_a) FROM faulty WHERE code % 1013 = 0),
raw AS MATERIALIZED (SELECT {_join(f"CASE WHEN {c} NOT IN ({_join(repr(t) for t in _NULL_TOKENS)}) THEN {c} END AS {c}" for c in REQUIRED)} FROM raw0)"""


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def num(c: str) -> str:
    pattern = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
    return f"CASE WHEN regexp_matches({c}, '{pattern}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def date(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END"


TYPED = RAW + f""",
typed AS (SELECT {strip('entity')} AS entity, {date('d')} AS d, {_join(f'{num(c)} AS {c}' for c in NUMERIC)},
          {strip('bucket')} AS bucket FROM raw)"""

SPLIT = PANEL + """,
positions AS (SELECT *, target IS NOT NULL AS target_valid, row_number() OVER (PARTITION BY entity ORDER BY d) AS pos,
              count(*) OVER (PARTITION BY entity) AS n FROM panel),
sizes AS (SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS nt, CAST(floor(n * 0.15::DOUBLE) AS BIGINT) AS nv FROM positions),
splits AS MATERIALIZED (SELECT *, CASE WHEN pos <= nt THEN 'train' WHEN pos <= nt + nv THEN 'val' ELSE 'test' END AS split,
  CASE WHEN pos <= nt THEN pos WHEN pos <= nt + nv THEN pos - nt ELSE pos - nt - nv END AS spos,
  CASE WHEN pos <= nt THEN nt WHEN pos <= nt + nv THEN nv ELSE n - nt - nv END AS sn FROM sizes)"""


def ffill(c: str, by: str = "entity, split") -> str:
    return f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


_KEEP = "entity, d, bucket, target_valid, pos, n, split, spos, sn"
FILLED = SPLIT + f""",
filled AS MATERIALIZED (SELECT {_KEEP}, {_join(f'{ffill(c)} AS {c}' for c in NUMERIC)} FROM splits),
medians AS MATERIALIZED (SELECT {_join(f"coalesce(quantile_cont({c}, 0.5), 0.0) AS {c}" for c in NUMERIC)} FROM filled WHERE split = 'train')"""

IMPUTED = FILLED + f""",
imputed AS MATERIALIZED (SELECT {_join('f.' + k for k in _KEEP.split(', '))}, {_join(f'coalesce(f.{c}, m.{c}) AS {c}' for c in NUMERIC)}
            FROM filled f CROSS JOIN medians m)"""

SCALED = IMPUTED + f""",
moments AS MATERIALIZED (SELECT {_join(f"avg({c}) AS m_{c}, CASE WHEN var_pop({c}) > 0 THEN sqrt(var_pop({c})) ELSE 1.0 END AS s_{c}" for c in NUMERIC)}
            FROM imputed WHERE split = 'train'),
scaled AS MATERIALIZED (SELECT i.*, {_join(f'(i.{c} - m_{c}) / s_{c} AS scaled_{c}' for c in NUMERIC)} FROM imputed i CROSS JOIN moments)"""


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY entity, split ORDER BY d ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def lag(c: str, k: int) -> str:
    """Shift inside the split; ``backfill`` comes after."""
    return f"lag({c}, {k}) OVER (PARTITION BY entity, split ORDER BY d) AS {c}_shift_{k}"


def backfill(c: str, k: int) -> str:
    after = "OVER (PARTITION BY entity, split ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"first_value({c}_shift_{k} IGNORE NULLS) {after} AS {c}_lag_{k}"


def rolling(name: str) -> str:
    c, rest = name.split("_roll_")
    kind, w = rest.split("_")
    if kind == "std":
        return f"coalesce(stddev_samp({c}) {_frame(int(w))}, 0.0)"
    fn = "avg" if kind == "mean" else kind
    return f"{fn}({c}) {_frame(int(w))}"


_SHIFTS = [(c, k) for c in [*_LAGGED, "disc_a"] for k in _BACK]
_SHIFTED, _FILLED = [lag(c, k) for c, k in _SHIFTS], [backfill(c, k) for c, k in _SHIFTS]
_ROLLING = [f"{rolling(n)} AS {n}" for n in CATEGORY_OF["rolling"]]
_ROC = [
    f"least(greatest(({c} - {c}_lag_{k}) / (abs({c}_lag_{k}) + 1e-4::DOUBLE), -5.0::DOUBLE), 5.0::DOUBLE) AS {c}_roc_{k}"
    for c in _CHANGED for k in _BACK
]
_VOL = [
    f"least(greatest({c}_roll_std_{w} / (abs({c}_roll_mean_{w}) + 1e-4::DOUBLE), 0.0::DOUBLE), 5.0::DOUBLE) AS {c}_volatility_{w}"
    for c in _VOLATILE for w in (7, 14)
]
SEASON = "CASE WHEN month(d) IN (3,4,5) THEN 1 WHEN month(d) IN (6,7,8,9) THEN 2 WHEN month(d) IN (10,11) THEN 3 ELSE 0 END"
_PHASE = {"day_of_week": "(isodow(d) - 1) / 7.0::DOUBLE", "month": "month(d) / 12.0::DOUBLE",
          "day_of_year": "dayofyear(d) / 365.25::DOUBLE", "season": f"({SEASON}) / 4.0::DOUBLE"}
CALENDAR = {f"{n}_{fn}": f"{fn}(2 * pi() * {p})" for n, p in _PHASE.items() for fn in ("sin", "cos")}

ENGINEERED = SCALED + f""",
shifted AS (SELECT *, {_join(_SHIFTED)}, {_join(_ROLLING)} FROM scaled),
windowed AS (SELECT *, {_join(_FILLED)} FROM shifted),
engineered AS MATERIALIZED (SELECT *, {_join(f'{e} AS {n}' for n, e in CALENDAR.items())}, {_join(_ROC)}, {_join(_VOL)} FROM windowed)"""

MODEL_READY = ENGINEERED + f""",
fmoments AS MATERIALIZED (SELECT {_join(f"avg({c}) AS m2_{c}, CASE WHEN var_pop({c}) > 0 THEN sqrt(var_pop({c})) ELSE 1.0 END AS s2_{c}" for c in CONTINUOUS)}
             FROM engineered WHERE split = 'train'),
model AS MATERIALIZED (SELECT e.* REPLACE ({_join(f'(e.{c} - m2_{c}) / s2_{c} AS {c}' for c in CONTINUOUS)}) FROM engineered e CROSS JOIN fmoments)"""


def windows(isolated: bool = False, horizon: int = 1, lookback: int = 30) -> str:
    by, at, length = ("entity, split", "spos", "sn") if isolated else ("entity", "pos", "n")
    w = f"OVER (PARTITION BY {by} ORDER BY d)"
    total = " + ".join(f"CAST({c} AS FLOAT)::DOUBLE" for c in MODEL)
    weighted = " + ".join(f"{j % 7 + 1} * CAST({c} AS FLOAT)::DOUBLE" for j, c in enumerate(MODEL))
    steps = f"OVER (PARTITION BY {by} ORDER BY d ROWS BETWEEN {lookback - 1} PRECEDING AND CURRENT ROW)"
    return MODEL_READY + f""",
stepped AS (SELECT *, {total} AS step_sum, {weighted} AS step_weighted FROM model),
candidates AS MATERIALIZED (SELECT * FROM (
  SELECT entity, {at} AS place, {length} AS len, d AS input_end, lag(d, {lookback - 1}) {w} AS input_start,
    lead(d, {horizon}) {w} AS target_time, lead(CAST(target AS FLOAT), {horizon}) {w} AS y,
    lead(CAST(scaled_target AS FLOAT), {horizon}) {w} AS y_scaled, lead(target_valid, {horizon}) {w} AS target_observed,
    lead(split, {horizon}) {w} AS split,
    sum(step_sum) {steps} AS x_sum,
    sum(step_weighted * {at}) {steps} - ({at} - {lookback}) * sum(step_weighted) {steps} AS x_weighted,
    lag(CAST({MODEL[0]} AS FLOAT)::DOUBLE, {lookback - 1}) {w} AS x_first, CAST({MODEL[-1]} AS FLOAT)::DOUBLE AS x_last
  FROM stepped) WHERE place >= {lookback} AND place + {horizon} <= len)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)
