"""Registered model queries.

Fitted values have no SQL equivalent, so each query has a form that SQL can
check (keys, counts, flags) and, where it differs, one with the values
(``_values``, rows only).  What the fits rest on is checked by value: the best
split of a first tree's root (``gbt_root_splits``) and the sums of products of
the ridge (``ridge_gram``).  Fits are kept per session and panel, so the
forecast, importance and persistence queries share one CV run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.cols import round_doubles
from tidecast.operators import boosting as B
from tidecast.operators import combine as C
from tidecast.operators import ridge as RG
from tidecast.operators.folds import holdout_folds
from tidecast.operators.metrics import cv_score, mae
from tidecast.plans import models as M
from tidecast.plans.catalog import register, tables
from tidecast.plans.features import base_data, build_features, feature_columns
from tidecast.plans.oracle import base_data_cte, cents, features_sql_body, with_fixtures
from tidecast.sources import fixtures as fx
from tidecast.sources.io import read_predictions, scratch_path, write_importance

_CACHE: dict = {}
ENSEMBLE_VERSIONS = (2, 4)
#: Sixty fits (2 versions, 10 horizons, 3 folds) end sooner than the library's patience of 200 would let them; see README.
ENSEMBLE_BOOSTER = dict(patience=10)


def _once(spark: SparkSession, t, kind: str, make):
    """What ``make`` returns, once for each session, panel and kind."""
    key = (spark.sparkContext.applicationId, tuple(t.stores.inputFiles()), kind)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


def _boosted(spark: SparkSession, d: str) -> M.Boosted:
    """v4 features, one month ahead, with the library's settings."""
    t = tables(spark, d)
    return _once(spark, t, "gbt", lambda: M.fit_boosted(build_features(t, 4, 1).withColumn("horizon", F.lit(1)), 4))


def _cv(spark: SparkSession, d: str, kind: str) -> M.CVResult:
    if kind == "gbt":
        return _boosted(spark, d).cv()
    t = tables(spark, d)
    return _once(spark, t, kind, lambda: M.fit_ridge_cv(build_features(t, 2, 1), 2))


_UNLABELLED = with_fixtures(base_data_cte(fx.end_date(1), False)) + (
    "SELECT store, dept, dt, {} FROM base_data WHERE sales IS NULL")
_KEYS_SQL = _UNLABELLED.format("CAST(3 AS BIGINT) AS n_folds, true AS has_pred")


def _keys_of(res: M.CVResult) -> DataFrame:
    return M.fold_average(res.test).select(*M.KEY, "n_folds", F.col("pred").isNotNull().alias("has_pred"))


@register("gbt_forecast", _KEYS_SQL)
def gbt_forecast(spark: SparkSession, d: str) -> DataFrame:
    """v4 features, one month ahead: every unlabelled row has three fold forecasts."""
    return _keys_of(_cv(spark, d, "gbt"))


@register("gbt_forecast_values")
def gbt_forecast_values(spark: SparkSession, d: str) -> DataFrame:
    """The forecasts: mean of the three fold boosters."""
    return round_doubles(M.fold_average(_cv(spark, d, "gbt").test))


@register("gbt_cv_score", "SELECT CAST(3 AS BIGINT) AS n_folds, true AS positive")
def gbt_cv_score(spark: SparkSession, d: str) -> DataFrame:
    wide = M.train_predictions(_boosted(spark, d).valid_rows())
    score = cv_score(wide, [f"pred_fold{i}" for i in range(M.N_FOLDS)])
    return score.select("n_folds", (F.col("cv_wmae") > 0).alias("positive"))


def _importance(spark: SparkSession, d: str) -> DataFrame:
    return M.importance(_boosted(spark, d))


@register("importance", "SELECT feature, true AS has_gain FROM (VALUES " + ", ".join(
    f"('{c}')" for c in feature_columns(4)) + ") t(feature)")
def importance(spark: SparkSession, d: str) -> DataFrame:
    """Gain importance of all features, written as CSV and read back."""
    path = scratch_path(spark, "importance")
    write_importance(_importance(spark, d), path)
    table = spark.read.schema("feature string, mean double, std double").option("header", True).csv(path)
    return table.select("feature", (F.col("mean").isNotNull() & F.col("std").isNotNull()).alias("has_gain"))


@register("importance_values")
def importance_values(spark: SparkSession, d: str) -> DataFrame:
    """Mean and std of the gain over folds, largest first."""
    return _importance(spark, d)


@register("importance_top50")
def importance_top50(spark: SparkSession, d: str) -> DataFrame:
    """The 50 largest (the limit is the report)."""
    return _importance(spark, d).limit(50)


@register("model_roundtrip", _UNLABELLED.format("true AS same_pred"))
def model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Boosters saved and loaded back give the same forecasts."""
    fits = _boosted(spark, d)
    again = fits.test_rows(M.load_nodes(spark, M.save_nodes(fits.nodes, scratch_path(spark, "models"))))
    both = M.fold_average(fits.test_rows()).join(M.fold_average(again).select(*M.KEY, F.col("pred").alias("again")), M.KEY, "full_outer")
    return both.select(*M.KEY, F.coalesce(F.abs(F.col("pred") - F.col("again")) < 1e-6, F.lit(False)).alias("same_pred"))


@register("gbt_rounds")
def gbt_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Best round, its validation error and the rounds tried, by fold."""
    return spark.createDataFrame(_boosted(spark, d).info(), "fit int, fold int, best_iter int, valid_mae double, rounds int")


_ROOT_COLUMNS = ("month", "weekofyear", "week", "superbowl", "thanksgiving", "christmas", "size", "unemployment")
_ROOT_BOOSTER = replace(M.BOOSTER, row_share=1.0, column_share=1.0, max_rounds=1)


def _root_sql() -> str:
    """The best cut of every column at the root of a first tree, by brute force."""
    score = "power(greatest(abs({g}) - 0.1, 0), 2) / ({h} + 0.1)"
    values = {
        "month": "month(dt)", "weekofyear": "week(dt)", "week": "least(day(dt) // 7, 3)", "size": "size", "unemployment": "unemployment",
        **{name: f"CAST(coalesce(is_holiday, false) AND month(dt) = {m} AS INTEGER)" for name, m in (("superbowl", 2), ("thanksgiving", 11), ("christmas", 12))},
    }
    arms = " UNION ALL ".join(f"SELECT dt, sales, weight, '{c}' AS feature, CAST({values[c]} AS DOUBLE) AS value FROM rows_" for c in _ROOT_COLUMNS)
    return with_fixtures(
        base_data_cte(fx.end_date(1), True),
        f"rows_ AS MATERIALIZED (SELECT *, CASE WHEN is_holiday THEN 5 ELSE 1 END AS weight, MAX(dt) OVER () AS last FROM base_data WHERE sales IS NOT NULL AND dt >= DATE '{fx.START}')",
        f"long AS ({arms})",
        "sums AS (SELECT fold, feature, value, SUM(-2.0 * weight * sales) AS g, SUM(2.0 * weight) AS h, COUNT(*) AS n FROM long, range(3) f(fold) "
        "WHERE dt <= (SELECT MAX(last) FROM rows_) - CAST(28 * (fold + 1) AS INTEGER) GROUP BY ALL)",
        "cum AS (SELECT fold, feature, value, SUM(g) OVER w AS g, SUM(h) OVER w AS h, SUM(n) OVER w AS n FROM sums WHERE value IS NOT NULL "
        "WINDOW w AS (PARTITION BY fold, feature ORDER BY value))",
        "total AS (SELECT fold, feature, SUM(g) AS tg, SUM(h) AS th, SUM(n) AS tn, COALESCE(SUM(g) FILTER (value IS NULL), 0) AS mg, "
        "COALESCE(SUM(h) FILTER (value IS NULL), 0) AS mh, COALESCE(SUM(n) FILTER (value IS NULL), 0) AS mn FROM sums GROUP BY fold, feature)",
        "cuts AS (SELECT fold, feature, value, side, g + CASE WHEN side THEN mg ELSE 0 END AS lg, h + CASE WHEN side THEN mh ELSE 0 END AS lh, "
        "n + CASE WHEN side THEN mn ELSE 0 END AS ln, tg, th, tn FROM cum JOIN total USING (fold, feature), (VALUES (true), (false)) s(side))",
        f"gains AS (SELECT *, {score.format(g='lg', h='lh')} + {score.format(g='(tg - lg)', h='(th - lh)')} - {score.format(g='tg', h='th')} AS gain, {score.format(g='tg', h='th')} AS base "
        "FROM cuts WHERE ln >= 10 AND tn - ln >= 10)",
        "best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY fold, feature ORDER BY round(gain / base, 10) DESC, side DESC, value) AS place FROM gains WHERE gain > 0)",
    ) + ("SELECT CAST(fold AS INTEGER) AS fold, feature, value AS cut, side AS missing_left, CAST(ln AS BIGINT) AS n_left, "
         f"{cents('gain / base * 1e6')} AS gain_ppm FROM best WHERE place = 1")


@register("gbt_root_splits", _root_sql)
def gbt_root_splits(spark: SparkSession, d: str) -> DataFrame:
    """Best split of each column at the root of a first tree, by fold: cut, side
    of missing values, rows on the left, gain in millionths of the root's (M6)."""
    df = M.training_frame(base_data(tables(spark, d), 1, 4)).where((F.col("dt") >= F.lit(fx.START)) & F.col("sales").isNotNull())
    cols = df.select("sales", "weight", *M.KEY, *[F.col(c).cast("double").alias(c) for c in _ROOT_COLUMNS], F.lit(0).alias("fit"))
    train = holdout_folds(cols, M.N_FOLDS)
    bins = B.quantile_bins(train, _ROOT_COLUMNS)
    splits = B.root_splits(B.write_chunks(train, bins, M.KEY, "sales", "weight", M.FOLDS), M.N_FOLDS, bins, _ROOT_BOOSTER)
    return round_doubles(splits.select("fold", "feature", "cut", "missing_left", "n_left", (F.col("gain") / F.col("base") * 1e6).alias("gain_ppm")), exclude=("cut",))


@register("ridge_forecast", _KEYS_SQL)
def ridge_forecast(spark: SparkSession, d: str) -> DataFrame:
    """v2 features, one month ahead: every unlabelled row has three fold forecasts."""
    return _keys_of(_cv(spark, d, "ridge"))


@register("ridge_forecast_values")
def ridge_forecast_values(spark: SparkSession, d: str) -> DataFrame:
    """The forecasts: mean of the three fold ridge models."""
    return round_doubles(M.fold_average(_cv(spark, d, "ridge").test))


@register("ridge_grid", "SELECT CAST(f AS INTEGER) AS fold, CAST(a AS INTEGER) AS alpha_index, true AS has_mae, "
          "CAST(1 AS BIGINT) AS n_chosen FROM range(3) x(f), range(10) y(a)")
def ridge_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every penalty was tried on every fold, and one of each fold was chosen."""
    rows = ridge_grid_values(spark, d)
    index = F.round(F.col("alpha") * (len(M.RIDGE_ALPHAS) - 1)).cast("int")
    chosen = rows.groupBy("fold").agg(F.sum(F.col("chosen").cast("int")).alias("n_chosen"))
    return rows.select("fold", index.alias("alpha_index"), F.col("mae").isNotNull().alias("has_mae")).join(chosen, "fold")


@register("ridge_grid_values")
def ridge_grid_values(spark: SparkSession, d: str) -> DataFrame:
    """Validation MAE of every penalty on every fold."""
    return spark.createDataFrame(_cv(spark, d, "ridge").info, "fold int, alpha double, mae double, chosen boolean")


def _gram_sql() -> str:
    """Sums of products of the imputed, standardised columns by ring of dates."""
    cols = M.ridge_columns(2)
    ctes, inner = features_sql_body(2, 1)
    value = {
        "month": "month(dt)", "weekofyear": "week(dt)", "week": "least(day(dt) // 7, 3)",
        **{name: f"CAST(coalesce(is_holiday, false) AND month(dt) = {m} AS INTEGER)" for name, m in (("thanksgiving", 11), ("christmas", 12))},
    }
    raw = ", ".join(f"CAST({value.get(c, c)} AS DOUBLE) AS x{i}" for i, c in enumerate(cols))
    stats = ", ".join(f"AVG(x{i}) AS m{i}" for i in range(len(cols)))
    filled = ", ".join(f"COALESCE(x{i}, (SELECT m{i} FROM means), 0) AS x{i}" for i in range(len(cols)))
    spread = ", ".join(f"AVG(x{i}) AS m{i}, STDDEV_POP(x{i}) AS s{i}" for i in range(len(cols)))
    scaled = ", ".join(f"(x{i} - (SELECT m{i} FROM spread)) / COALESCE(NULLIF((SELECT s{i} FROM spread), 0), 1) AS x{i}" for i in range(len(cols)))
    width = len(cols)
    pairs = [("1", -2, -2), ("y", -2, -1), ("y * y", -1, -1)]
    pairs += [(f"x{i}", -2, i) for i in range(width)] + [(f"y * x{i}", -1, i) for i in range(width)]
    pairs += [(f"x{i} * x{j}", i, j) for i in range(width) for j in range(i, width)]
    sums = ", ".join(f"SUM({e}) AS t{k}" for k, (e, _, _) in enumerate(pairs))
    listed = ", ".join(f"{{'i': {i}, 'j': {j}, 'total': t{k}}}" for k, (_, i, j) in enumerate(pairs))
    return with_fixtures(
        *ctes, f"feat AS ({inner})",
        f"raw AS MATERIALIZED (SELECT dt, sales AS y, {raw} FROM feat WHERE sales IS NOT NULL AND lag1_store_dept_sales IS NOT NULL)",
        f"means AS MATERIALIZED (SELECT {stats} FROM raw)",
        f"filled AS MATERIALIZED (SELECT dt, y, {filled} FROM raw)",
        f"spread AS MATERIALIZED (SELECT {spread} FROM filled)",
        f"scaled AS MATERIALIZED (SELECT CASE WHEN dt > last - 28 THEN 0 WHEN dt > last - 56 THEN 1 WHEN dt > last - 84 THEN 2 ELSE {RG.ALWAYS} END AS ring, y, {scaled} "
        "FROM (SELECT *, MAX(dt) OVER () AS last FROM filled))",
        f"sums AS (SELECT ring, {sums} FROM scaled GROUP BY ring)",
        f"long AS (SELECT ring, unnest([{listed}]) AS x FROM sums)",
        "sizes AS (SELECT ring, COUNT(*) AS n FROM scaled GROUP BY ring)",
    ) + f"SELECT CAST(ring AS INTEGER) AS ring, x.i AS i, x.j AS j, {cents('x.total / n')} AS mean FROM long JOIN sizes USING (ring)"


@register("ridge_gram", _gram_sql)
def ridge_gram(spark: SparkSession, d: str) -> DataFrame:
    """Mean products by ring of dates: with the rows of the rings, all that the
    ridge of every fold and penalty needs (M9)."""
    t = tables(spark, d)
    train, _, cols = M.ridge_frames(build_features(t, 2, 1), 2)
    rows = RG.gram_rows(train, cols, M.LABEL, M.N_FOLDS)
    sizes = rows.where("i = -2 and j = -2").select("ring", F.col("total").alias("n"))
    return round_doubles(rows.join(sizes, "ring").select("ring", "i", "j", (F.col("total") / F.col("n")).alias("mean")))


@register("ridge_horizons", with_fixtures() + f"""SELECT store, dept, dt, CAST(h AS INTEGER) AS horizon, true AS has_pred
FROM future, range(1, 11) x(h) WHERE dt <= DATE '{fx.CUTOFF}' + CAST(h * 28 AS INTEGER)""")
def ridge_horizons(spark: SparkSession, d: str) -> DataFrame:
    """v2 ridge for every horizon: each unlabelled row that a horizon sees has a forecast."""
    t = tables(spark, d)
    return _once(spark, t, "ridge_horizons", lambda: M.ridge_horizons(t, 2)).select(*M.KEY, "horizon", F.col("pred").isNotNull().alias("has_pred"))


# --- the training path over all horizons ------------------------------------------

def _sink(spark: SparkSession, d: str) -> str:
    """Both versions trained for every horizon, both sides of every fit written."""
    def make() -> str:
        path = scratch_path(spark, "horizon-predictions")
        for v in ENSEMBLE_VERSIONS:
            M.write_horizon_predictions(M.fit_horizons(t, v, **ENSEMBLE_BOOSTER), f"v{v}", path)
        return path

    t = tables(spark, d)
    return _once(spark, t, "ensemble", make)


def _combined(spark: SparkSession, d: str, version: int) -> DataFrame:
    """Mean over horizons on the spine of the last one, scaled dates."""
    preds = read_predictions(spark, _sink(spark, d), f"v{version}")
    spine = preds.where(F.col("horizon") == max(fx.HORIZONS)).select(*M.KEY)
    mean = C.horizon_mean(preds, spine=spine)
    d0, d1 = fx.POST_WEEKS
    return C.scale_dates(mean, {d0: 6 / 7, d1: 8 / 7})


_SPINE_SQL = with_fixtures() + f"""SELECT concat_ws('_', store, dept, dt) AS id, CAST(3 AS BIGINT) AS n_models, true AS has_pred,
  CAST(11 - GREATEST(1, CAST(ceil(date_diff('day', DATE '{fx.CUTOFF}', dt) / 28.0) AS INTEGER)) AS BIGINT) AS n_horizons
FROM future WHERE dt <= DATE '{fx.end_date(10)}'"""


def _ensemble(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    parts = [_combined(spark, d, v) for v in ENSEMBLE_VERSIONS]
    named = [p.withColumn("id", C.series_id("store", "dept", "dt")) for p in parts]
    baseline = C.hier_forecast(t.history, t.future.where(F.col("dt") <= F.lit(fx.end_date(max(fx.HORIZONS)))))
    out = C.blend([*named, baseline])
    return out.join(named[0].select("id", "n_horizons"), "id", "left")


@register("ensemble_submission", _SPINE_SQL)
def ensemble_submission(spark: SparkSession, d: str) -> DataFrame:
    """(v2 + v4 + baseline) / 3 on the spine of ten horizons (M17): every key
    has all models, and each row the horizons that reach it."""
    return _ensemble(spark, d).select("id", "n_models", F.col("pred").isNotNull().alias("has_pred"), "n_horizons")


@register("ensemble_submission_values")
def ensemble_submission_values(spark: SparkSession, d: str) -> DataFrame:
    return round_doubles(_ensemble(spark, d))


@register("train_predictions", with_fixtures(base_data_cte(fx.end_date(1), False)) + f"""SELECT 'v' || v AS model, CAST(h AS INTEGER) AS horizon, COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE dt > last - 28) AS n_fold0, COUNT(*) FILTER (WHERE dt > last - 56) AS n_fold1, COUNT(*) AS n_fold2
FROM (SELECT dt, MAX(dt) OVER () AS last FROM base_data WHERE sales IS NOT NULL), (VALUES (2), (4)) a(v), range(1, 11) b(h)
WHERE dt > last - 84 GROUP BY ALL""")
def train_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the training-side sink by model, horizon and fold."""
    parts = []
    for v in ENSEMBLE_VERSIONS:
        rows = read_predictions(spark, _sink(spark, d), f"v{v}", "train")
        parts.append(rows.groupBy(F.lit(f"v{v}").alias("model"), F.col("horizon").cast("int")).agg(
            F.count(F.lit(1)).alias("n_rows"), *[F.count(f"pred_fold{i}").alias(f"n_fold{i}") for i in range(M.N_FOLDS)]))
    return M._union(parts)


@register("ensemble_mae")
def ensemble_mae(spark: SparkSession, d: str) -> DataFrame:
    """MAE of each version's last fold on its training side."""
    parts = []
    for v in ENSEMBLE_VERSIONS:
        rows = read_predictions(spark, _sink(spark, d), f"v{v}", "train")
        parts.append(mae(rows, "sales", "pred_fold2").select(F.lit(f"v{v}").alias("model"), "mae", "n"))
    return M._union(parts)
