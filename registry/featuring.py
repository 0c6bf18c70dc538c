"""Engineered features."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from longspan.operators import features, split, validate
from registry import sql
from registry.core import FEATURES, NUMERIC, SPEC, engineered, model_ready, panel, prepared, query, tidy

_KEYS = f"entity, {sql.day('d', 'd')}, split"


def _select(names) -> str:
    return f"SELECT {_KEYS}, {', '.join(sql.r(n, n) for n in names)} FROM engineered"


def _register(name: str, category: str, names: list[str]):
    @query(name, sql.with_(sql.ENGINEERED, _select(names)))
    def run(spark, sf):
        out = features.engineer(prepared(spark, sf).table, SPEC, FEATURES, (category,))
        return tidy(out.select("entity", "d", "split", *names))


for _id, _stem in (("F1", "day_of_week"), ("F2", "month"), ("F3", "day_of_year"), ("F4", "season")):
    _register(f"{_id}_{_stem}", "calendar", [f"{_stem}_sin", f"{_stem}_cos"])
_register("F5_lag", "lag", sql.CATEGORY_OF["lag"])
for _id, _kind in (("F6", "mean"), ("F7", "std")):
    _register(f"{_id}_rolling_{_kind}", "rolling", [n for n in sql.CATEGORY_OF["rolling"] if f"_roll_{_kind}_" in n])
_register("F8_rolling_min_max", "rolling", [n for n in sql.CATEGORY_OF["rolling"] if "_roll_m" in n and "_mean_" not in n])
_register("F9_rate_of_change", "roc", sql.CATEGORY_OF["roc"])
_register("F10_volatility", "volatility", sql.CATEGORY_OF["volatility"])


@query("F5_lag_with_gaps", sql.with_(sql.SPLIT + """,
back AS (SELECT *, first_value(CASE WHEN qty_a IS NOT NULL THEN spos END IGNORE NULLS) OVER w AS place, first_value(qty_a IGNORE NULLS) OVER w AS v
         FROM splits WINDOW w AS (PARTITION BY entity, split ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
moved AS (SELECT *, first_value(place) OVER w AS place3, first_value(v) OVER w AS v3 FROM back
          WINDOW w AS (PARTITION BY entity, split ORDER BY d ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))""",
    f"SELECT {_KEYS}, {sql.r('CASE WHEN place3 <= sn - 3 THEN v3 END', 'qty_a_lag_3')} FROM moved"))
def lag_with_gaps(spark, sf):
    rows = split.assign_split(panel(spark, sf), SPEC)
    return tidy(features.anchored_lag(rows, SPEC, "qty_a", 3).select("entity", "d", "split", "qty_a_lag_3"))


_ENGINEERED = [*sql.CATEGORY_OF["calendar"], *sql.CONTINUOUS]


@query("F11_all_features", sql.with_(sql.ENGINEERED, _select(_ENGINEERED)))
def all_features(spark, sf):
    return tidy(features.engineer(prepared(spark, sf).table, SPEC, FEATURES).select("entity", "d", "split", *_ENGINEERED))


@query("F12_scaled_features", sql.with_(sql.MODEL_READY, f"SELECT {_KEYS}, {', '.join(sql.r(n, n) for n in sql.CONTINUOUS)} FROM model"))
def scaled_features(spark, sf):
    return tidy(model_ready(spark, sf)[0].select("entity", "d", "split", *sql.CONTINUOUS))


@query("F13_model_features", sql.with_(sql.MODEL_READY, f"SELECT {', '.join(sql.r(n, n) for n in sql.MODEL)} FROM model"))
def model_features(spark, sf):
    data, names = model_ready(spark, sf)
    return tidy(data.select(*names))


@query("F14_future_probe", sql.with_(sql.ENGINEERED, "SELECT entity, CAST(d AS VARCHAR) AS d, split FROM engineered WHERE 1 = 0"))
def future_probe(spark, sf):
    """Rows whose features change when every later row of their split is altered: none."""
    base = prepared(spark, sf).table
    cut = F.col("_split_pos") > F.floor(F.col("_split_rows") / 2)
    altered = base.withColumns({c: F.when(cut, F.lit(10000.0)).otherwise(F.col(c)) for c in NUMERIC})
    names = ["entity", "d", "split", *sql.CONTINUOUS]
    kept = features.engineer(base, SPEC, FEATURES).where(~cut).select(names)
    probe = features.engineer(altered, SPEC, FEATURES).where(~cut).select(names)
    return tidy(kept.exceptAll(probe).select("entity", "d", "split"))


_CENTRED = "avg(qty_a) OVER (PARTITION BY entity, split ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"


@query("F14_centred_probe", sql.with_(sql.IMPUTED + f""",
plain AS (SELECT entity, d, split, spos, sn, {_CENTRED} AS v FROM imputed),
changed AS (SELECT entity, d, split, avg(v) OVER (PARTITION BY entity, split ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS v
  FROM (SELECT entity, d, split, CASE WHEN spos > floor(sn / 2) THEN 10000.0 ELSE qty_a END AS v FROM imputed))""", """
SELECT p.entity, CAST(p.d AS VARCHAR) AS d, p.split FROM plain p JOIN changed c ON p.entity = c.entity AND p.d = c.d
WHERE p.spos <= floor(p.sn / 2) AND abs(p.v - c.v) > 1e-9"""))
def centred_probe(spark, sf):
    """The same probe on a window that looks ahead: it must name the rows before the cut that see altered ones."""
    base = prepared(spark, sf).table
    cut = F.col("_split_pos") > F.floor(F.col("_split_rows") / 2)
    altered = base.withColumn("qty_a", F.when(cut, F.lit(10000.0)).otherwise(F.col("qty_a")))
    centred = F.avg("qty_a").over(Window.partitionBy("entity", "split").orderBy("d").rowsBetween(-3, 3))

    def probed(df):
        return df.withColumn("v", F.round(centred, 6)).where(~cut).select("entity", "d", "split", "v")

    return tidy(probed(base).exceptAll(probed(altered)).select("entity", "d", "split"))


@query("B14_first_difference", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.day('d', 'd')}, {', '.join(sql.r(f'{c} - lag({c}) OVER (PARTITION BY entity ORDER BY panel.d)', f'{c}_diff') for c in NUMERIC)} FROM panel"""))
def first_difference(spark, sf):
    rows = split.with_position(panel(spark, sf), SPEC)
    return tidy(features.first_difference(rows, SPEC, NUMERIC).select("entity", "d", *[f"{c}_diff" for c in NUMERIC]))
