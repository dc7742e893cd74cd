"""Registered queries: window features one level at a time, the statistical
baseline, multi-horizon / multi-model combination, folds, metrics and
encoding (W1-W9, J4-J6, C13-C18, M1-M5, M8, M13-M18, A13-A19, S3-S6).

Combination operators are fed with deterministic forecasts derived from
the data (the statistical baseline times 1 + 0.01 * horizon, restricted to
each horizon's window) so that every one of them has an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.functions.cols import parse_submission_id, round_doubles, series_id
from tidecast.functions.dates import row_weight
from tidecast.operators import combine as C
from tidecast.operators.encode import impute_mean, label_decode, label_encode, standardize
from tidecast.operators.folds import holdout_folds
from tidecast.operators.joins import rows_with_lag
from tidecast.operators.metrics import cv_score, fold_scores, mae, wmae
from tidecast.operators.windows import (
    LEVELS, OPS, SPANS, expanding_lagged_avg, feature_name, lagged_range, lead_lag, rolling_mean,
    seasonal_value,
)
from tidecast.plans.catalog import register, tables
from tidecast.plans.eda_queries import _HIER_JOIN, _SEASON
from tidecast.plans.features import base_data, build_all_horizons, build_features
from tidecast.plans.oracle import (
    _SQL_OP, base_data_cte, cents, features_sql, features_sql_body, range_frame, rounded, with_fixtures,
)
from tidecast.sources import fixtures as fx
from tidecast.sources.io import read_features, read_predictions, read_submission, scratch_path, write_bucketed, \
    write_features, write_predictions, write_submission

R = round_doubles
W = with_fixtures
KEY = ["store", "dept", "dt"]
D0, D1 = fx.POST_WEEKS
RATIOS = {D0: 6 / 7, D1: 8 / 7}


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _bd(h: int = 1, norm: bool = False) -> str:
    return base_data_cte(fx.end_date(h), norm)


# --- window features, one level / kind at a time -------------------------------

def _level_sql(value: str, keys, base: int = 28) -> str:
    cols = [f"{_SQL_OP[op]}({value}) {range_frame(keys, span + base, base)} AS "
            f"{feature_name(value, op, keys, span_name)}" for span_name, span in SPANS.items() for op in OPS]
    names = [feature_name(value, op, keys, s) for s in SPANS for op in OPS]
    return (W(_bd(1, norm=value == "norm_sales"), f"w AS (SELECT store, dept, dt, {', '.join(cols)} FROM base_data)")
            + f"SELECT store, dept, dt, {rounded([(n, True) for n in names])} FROM w")


def _level_query(value: str, keys):
    def run(spark: SparkSession, d: str) -> DataFrame:
        bd = base_data(tables(spark, d), 1, version=4 if value == "norm_sales" else 1)
        out = lagged_range(bd, value, keys, 28)
        names = [feature_name(value, op, keys, s) for s in SPANS for op in OPS]
        return R(out.select(*KEY, *names))

    return run


for _keys in LEVELS:
    register(f"target_{'_'.join(_keys)}", _level_sql("sales", _keys))(_level_query("sales", _keys))


@register("bucketed_windows", _level_sql("sales", ("store", "dept")))
def bucketed_windows(spark: SparkSession, d: str) -> DataFrame:
    """The series-level windows over the panel stored in buckets of its series:
    the stored table is read without a shuffle (S3, S4, W1)."""
    bd = base_data(tables(spark, d), 1).select(*KEY, "day_num", "sales")
    stored = write_bucketed(bd, "panel_by_series", ["store", "dept"], int(spark.conf.get("spark.sql.shuffle.partitions")), ["dt"])
    out = lagged_range(stored, "sales", ("store", "dept"), 28)
    return R(out.select(*KEY, *[feature_name("sales", op, ("store", "dept"), s) for s in SPANS for op in OPS]))


@register("target_norm", W(_bd(1, norm=True), "w AS (SELECT store, dept, dt, " + ", ".join(
    f"{_SQL_OP[op]}(norm_sales) {range_frame(k, span + 28, 28)} AS {feature_name('norm_sales', op, k, s)}"
    for k in LEVELS for s, span in SPANS.items() for op in OPS) + " FROM base_data)")
    + "SELECT store, dept, dt, " + rounded([(feature_name("norm_sales", op, k, s), True)
                                            for k in LEVELS for s in SPANS for op in OPS]) + " FROM w")
def target_norm(spark: SparkSession, d: str) -> DataFrame:
    bd = base_data(tables(spark, d), 1, version=4)
    out = bd
    for k in LEVELS:
        out = lagged_range(out, "norm_sales", k, 28)
    return R(out.select(*KEY, *[feature_name("norm_sales", op, k, s) for k in LEVELS for s in SPANS for op in OPS]))


@register("same_week_avg", W(_bd(1, norm=True)) + "SELECT store, dept, dt, " + cents(
    f"AVG(sales) {range_frame(('store', 'dept', 'week'), None, 28)}") + " AS sales_avg_by_store_dept_week, " + cents(
    f"AVG(norm_sales) {range_frame(('store', 'dept', 'week'), None, 28)}") + " AS norm_sales_avg_by_store_dept_week "
    "FROM base_data")
def same_week_avg(spark: SparkSession, d: str) -> DataFrame:
    bd = base_data(tables(spark, d), 1, version=4)
    keys = ("store", "dept", "week")
    return R(bd.select(*KEY, expanding_lagged_avg("sales", keys, 28).alias("sales_avg_by_store_dept_week"),
                       expanding_lagged_avg("norm_sales", keys, 28).alias("norm_sales_avg_by_store_dept_week")))


_SEASON_KEYS = ("store", "dept", "month", "week")


@register("seasonal_first", W(_bd(3)) + "SELECT store, dept, dt, " + cents(
    f"FIRST_VALUE(sales) {range_frame(_SEASON_KEYS, None, 84)}") + " AS lag1_store_dept_sales, " + cents(
    f"LAST_VALUE(sales) {range_frame(_SEASON_KEYS, None, 84)}") + " AS last_store_dept_sales FROM base_data")
def seasonal_first(spark: SparkSession, d: str) -> DataFrame:
    """Oldest and most recent same-season value, 3 months back."""
    bd = base_data(tables(spark, d), 3)
    return R(bd.select(*KEY, seasonal_value("sales", 84).alias("lag1_store_dept_sales"),
                       seasonal_value("sales", 84, mode="last").alias("last_store_dept_sales")))


@register("lead_lag", W() + f"""SELECT store, dept, dt, {cents('sales')} AS sales,
  {cents('LEAD(sales) OVER w')} AS sales_lead1, {cents('LAG(sales) OVER w')} AS sales_lag1,
  LEAD(CAST(month(dt) AS INTEGER)) OVER w AS month_lead1, LAG(CAST(month(dt) AS INTEGER)) OVER w AS month_lag1
FROM history WINDOW w AS (PARTITION BY store, dept ORDER BY dt)""")
def lead_lag_q(spark: SparkSession, d: str) -> DataFrame:
    h = tables(spark, d).history.withColumn("month", F.month("dt"))
    out = lead_lag(h, ["sales", "month"])
    return R(out.select(*KEY, "sales", "sales_lead1", "sales_lag1", "month_lead1", "month_lag1"))


# --- statistical baseline and deterministic multi-horizon forecasts -------------

_HF = "hf AS (SELECT store, dept, dt, concat_ws('_', store, dept, dt) AS id, " \
      "COALESCE(mean_store_dept_month_week, mean_store_dept_month, mean_store_dept, 0) AS pred FROM hj)"
_PREDS = (f"preds AS (SELECT store, dept, dt, CAST(t.h AS INTEGER) AS horizon, "
          f"pred * ({dbl(1.0)} + {dbl(0.01)} * CAST(t.h AS INTEGER)) AS pred FROM hf, range(1, 11) t(h) "
          f"WHERE dt <= DATE '{fx.CUTOFF}' + CAST(28 * t.h AS INTEGER))")
_HM = "hm AS (SELECT store, dept, dt, AVG(pred) AS pred, COUNT(pred) AS n_horizons FROM preds GROUP BY ALL)"
_FC = [*_HIER_JOIN, _HF, _PREDS, _HM]


def _hier(spark: SparkSession, d: str, clamp_december: bool = True) -> DataFrame:
    t = tables(spark, d)
    return C.hier_forecast(t.history, t.future, clamp_december=clamp_december)


def _preds(spark: SparkSession, d: str) -> DataFrame:
    p = C.horizon_predictions(_hier(spark, d), fx.HORIZONS, fx.CUTOFF)
    return p.withColumn("pred", F.col("pred") * (F.lit(1.0) + F.lit(0.01) * F.col("horizon")))


def _hmean(spark: SparkSession, d: str) -> DataFrame:
    return C.horizon_mean(_preds(spark, d))


@register("hier_forecast", W(*_HIER_JOIN, _HF) + f"SELECT store, dept, dt, id, {cents('pred')} AS pred FROM hf")
def hier_forecast(spark: SparkSession, d: str) -> DataFrame:
    return R(_hier(spark, d))


_HIER_JOIN_DEC = [c.replace("CAST(LEAST(floor(day(dt) / 7), 3) AS INTEGER) AS week",
                            "CAST(CASE WHEN month(dt) = 12 THEN floor(day(dt) / 7) "
                            "ELSE LEAST(floor(day(dt) / 7), 3) END AS INTEGER) AS week") for c in _HIER_JOIN]


@register("hier_forecast_dec", W(*_HIER_JOIN_DEC, _HF) + f"SELECT store, dept, dt, id, {cents('pred')} AS pred FROM hf")
def hier_forecast_dec(spark: SparkSession, d: str) -> DataFrame:
    return R(_hier(spark, d, clamp_december=False))


@register("submission_parse", W(*_HIER_JOIN, _HF) + f"SELECT id, {cents('pred')} AS sales, store, dept, dt FROM hf")
def submission_parse(spark: SparkSession, d: str) -> DataFrame:
    """Baseline written as an (id, sales) CSV, read back and parsed."""
    path = scratch_path(spark, "submission")
    write_submission(_hier(spark, d), path)
    return R(parse_submission_id(read_submission(spark, path)))


@register("horizon_long", W(*_FC) + f"SELECT store, dept, dt, horizon, {cents('pred')} AS pred FROM preds")
def horizon_long(spark: SparkSession, d: str) -> DataFrame:
    """Ten horizons written partitioned by (model, horizon, split) and read
    back in one pruned scan (S5, S6)."""
    path = scratch_path(spark, "predictions")
    write_predictions(_preds(spark, d).withColumns({"model": F.lit("baseline"), "split": F.lit("test")}), path)
    return R(read_predictions(spark, path, "baseline").select(*KEY, F.col("horizon").cast("int"), "pred"))


@register("horizon_wide", W(*_FC) + "SELECT s.store, s.dept, s.dt, " + ", ".join(
    f"{cents(f'MAX(CASE WHEN p.horizon = {h} THEN p.pred END)')} AS pred_h{h}" for h in fx.HORIZONS)
    + " FROM (SELECT store, dept, dt FROM preds WHERE horizon = 10) s LEFT JOIN preds p USING (store, dept, dt) "
      "GROUP BY s.store, s.dept, s.dt")
def horizon_wide(spark: SparkSession, d: str) -> DataFrame:
    p = _preds(spark, d)
    spine = p.where(F.col("horizon") == 10).select(*KEY)
    return R(C.horizon_wide(p, fx.HORIZONS, spine))


@register("horizon_mean", W(*_FC) + f"SELECT store, dept, dt, {cents('pred')} AS pred, n_horizons FROM hm")
def horizon_mean(spark: SparkSession, d: str) -> DataFrame:
    return R(_hmean(spark, d))


@register("horizon_first", W(*_FC) + f"SELECT store, dept, dt, {cents('arg_min(pred, horizon)')} AS pred, "
          "MIN(horizon) AS horizon FROM preds WHERE pred IS NOT NULL GROUP BY ALL")
def horizon_first(spark: SparkSession, d: str) -> DataFrame:
    return R(C.horizon_first(_preds(spark, d)))


@register("forecast_by_date", W(*_FC) + f"SELECT dt, horizon, {cents('AVG(pred)')} AS mean_pred, COUNT(pred) AS n "
          "FROM preds GROUP BY ALL")
def forecast_by_date(spark: SparkSession, d: str) -> DataFrame:
    return R(C.forecast_by_date(_preds(spark, d)))


@register("forecast_vs_actual", W(*_FC, "u AS (SELECT dt, sales AS y, CAST(NULL AS DOUBLE) AS p FROM history "
                                  "UNION ALL SELECT dt, CAST(NULL AS DOUBLE), pred FROM hm)")
          + f"SELECT dt, {cents('AVG(y)')} AS mean_sales, {cents('AVG(p)')} AS mean_pred FROM u GROUP BY dt")
def forecast_vs_actual(spark: SparkSession, d: str) -> DataFrame:
    """Actual series and combined forecast by date."""
    return R(C.forecast_vs_actual(tables(spark, d).history, _hmean(spark, d)))


@register("horizon_mean_spine", W(*_FC, "sp AS (SELECT store, dept, dt FROM preds WHERE horizon = 10)")
          + f"SELECT store, dept, dt, {cents('hm.pred')} AS pred, COALESCE(hm.n_horizons, 0) AS n_horizons "
            "FROM sp LEFT JOIN hm USING (store, dept, dt)")
def horizon_mean_spine(spark: SparkSession, d: str) -> DataFrame:
    """Horizon mean on the keys of the ten-month horizon."""
    p = _preds(spark, d)
    return R(C.horizon_mean(p, spine=p.where(F.col("horizon") == 10).select(*KEY)))


_SCALED = (f"sc AS (SELECT store, dept, dt, concat_ws('_', store, dept, dt) AS id, CASE "
           f"WHEN dt = DATE '{D1}' THEN (CASE WHEN dt = DATE '{D0}' THEN pred * {dbl(RATIOS[D0])} ELSE pred END)"
           f" * {dbl(RATIOS[D1])} "
           f"WHEN dt = DATE '{D0}' THEN pred * {dbl(RATIOS[D0])} ELSE pred END AS pred FROM hm)")


@register("scale_dates", W(*_FC, _SCALED) + f"SELECT store, dept, dt, {cents('pred')} AS pred FROM sc")
def scale_dates(spark: SparkSession, d: str) -> DataFrame:
    return R(C.scale_dates(_hmean(spark, d), RATIOS).select(*KEY, "pred"))


_R0, _R1 = 6 / 14, 8 / 14


@register("xmas_redistribute", W(*_FC, """hm2 AS (SELECT *, LEAD(pred) OVER w AS nxt, LEAD(dt) OVER w AS nxt_dt,
  LAG(pred) OVER w AS prv, LAG(dt) OVER w AS prv_dt FROM hm WINDOW w AS (PARTITION BY store, dept ORDER BY dt))""")
    + f"""SELECT store, dept, dt, {cents(
        f"CASE WHEN dt = DATE '{D0}' AND nxt_dt = DATE '{D1}' AND nxt IS NOT NULL THEN (pred + nxt) * {dbl(_R0)} "
        f"WHEN dt = DATE '{D1}' AND prv_dt = DATE '{D0}' AND prv IS NOT NULL THEN (pred + prv) * {dbl(_R1)} "
        f"ELSE pred END")} AS pred FROM hm2""")
def xmas_redistribute(spark: SparkSession, d: str) -> DataFrame:
    return R(C.redistribute(_hmean(spark, d), D0, D1, _R0, _R1).select(*KEY, "pred"))


@register("blend_models", W(*_FC, _SCALED, f"""st AS (SELECT id, pred AS v, {dbl(1.0)} AS w FROM hf
  UNION ALL SELECT id, pred, {dbl(1.0)} FROM sc)""")
    + f"SELECT id, {cents('SUM(v * w) / SUM(w)')} AS pred, COUNT(*) AS n_models FROM st GROUP BY id")
def blend_models(spark: SparkSession, d: str) -> DataFrame:
    """Post-processed multi-horizon forecast averaged with the baseline."""
    model = C.scale_dates(_hmean(spark, d), RATIOS).withColumn("id", series_id("store", "dept", "dt"))
    return R(C.blend([_hier(spark, d), model]))


@register("rolling2", W(*_FC, """stk AS (SELECT store, dept, dt, sales FROM history
  UNION ALL SELECT store, dept, dt, pred FROM hm)""", """r AS (SELECT store, dept, dt, sales,
  CASE WHEN COUNT(sales) OVER w = 2 THEN AVG(sales) OVER w END AS rm FROM stk
  WINDOW w AS (PARTITION BY store, dept ORDER BY dt ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))""")
    + f"SELECT store, dept, dt, {cents('COALESCE(rm, sales)')} AS sales_rolling_mean FROM r "
      f"WHERE dt >= DATE '{fx.CUTOFF}'")
def rolling2(spark: SparkSession, d: str) -> DataFrame:
    """History stacked with the combined forecast, 2-row rolling mean with
    fallback, forecast weeks kept (W8, U2, P11)."""
    hist = tables(spark, d).history.select(*KEY, "sales")
    fc = _hmean(spark, d).select(*KEY, F.col("pred").alias("sales"))
    out = rolling_mean(hist.unionByName(fc), "sales")
    return R(out.where(F.col("dt") >= F.lit(fx.CUTOFF)).select(*KEY, "sales_rolling_mean"))


# --- folds, fold means and metrics ----------------------------------------------

_FOLD_SQL = [
    _bd(1),
    f"bh AS (SELECT store, dept, dt, sales, CAST(COALESCE(is_holiday, false) AS INTEGER) * 4 + 1 AS weight, "
    f"{_SEASON} FROM base_data WHERE sales IS NOT NULL)",
    "fit AS (SELECT *, AVG(sales) OVER (PARTITION BY store, dept, month, week) AS fitted, "
    "MAX(dt) OVER () AS last_dt FROM bh)",
    "fo AS (SELECT *, dt > last_dt - 28 AS valid_0, dt > last_dt - 56 AS valid_1, dt > last_dt - 84 AS valid_2, "
    "CASE WHEN dt > last_dt - 84 THEN 2 WHEN dt > last_dt - 56 THEN 1 WHEN dt > last_dt - 28 THEN 0 END AS fold FROM fit)",
    "fp AS (SELECT *, " + ", ".join(
        f"CASE WHEN valid_{i} THEN fitted * ({dbl(1.0)} + {dbl(0.001)} * {i}) END AS pred_fold{i}" for i in range(3))
    + " FROM fo)",
]


def _fold_frame(spark: SparkSession, d: str) -> DataFrame:
    bd = base_data(tables(spark, d), 1).where(F.col("sales").isNotNull())
    bd = C.with_season(bd.select(*KEY, "sales", row_weight().alias("weight")))
    bd = bd.withColumn("fitted", F.avg("sales").over(Window.partitionBy("store", "dept", "month", "week")))
    bd = holdout_folds(bd)
    return bd.withColumns({f"pred_fold{i}": F.when(F.col(f"valid_{i}"), F.col("fitted") * (F.lit(1.0) + F.lit(0.001) * i))
                           for i in range(3)})


_PRED_COLS = [f"pred_fold{i}" for i in range(3)]


@register("holdout_folds", W(*_FOLD_SQL) + "SELECT store, dept, dt, valid_0, valid_1, valid_2, fold FROM fo")
def holdout_folds_q(spark: SparkSession, d: str) -> DataFrame:
    return _fold_frame(spark, d).select(*KEY, "valid_0", "valid_1", "valid_2", "fold")


_ROWMEAN = ("CASE WHEN (pred_fold0 IS NOT NULL)::INT + (pred_fold1 IS NOT NULL)::INT + (pred_fold2 IS NOT NULL)::INT > 0"
            " THEN (COALESCE(pred_fold0, 0) + COALESCE(pred_fold1, 0) + COALESCE(pred_fold2, 0)) / "
            "((pred_fold0 IS NOT NULL)::INT + (pred_fold1 IS NOT NULL)::INT + (pred_fold2 IS NOT NULL)::INT) END")


@register("fold_mean", W(*_FOLD_SQL) + f"SELECT store, dept, dt, {rounded([(c, True) for c in _PRED_COLS])}, "
          f"{cents(_ROWMEAN)} AS pred FROM fp")
def fold_mean(spark: SparkSession, d: str) -> DataFrame:
    f = _fold_frame(spark, d)
    preds = C.columns_like(f, "pred_fold")
    return R(f.select(*KEY, *preds, C.row_mean(preds).alias("pred")))


_LONG = "lg AS (" + " UNION ALL ".join(
    f"SELECT {i} AS fold, sales, weight, pred_fold{i} AS p FROM fp WHERE pred_fold{i} IS NOT NULL" for i in range(3)) + ")"
_FS = "fs AS (SELECT fold, SUM(weight * abs(sales - p)) / SUM(weight) AS wmae, COUNT(*) AS n FROM lg GROUP BY fold)"


@register("fold_scores", W(*_FOLD_SQL, _LONG, _FS) + f"SELECT fold, {cents('wmae')} AS wmae, n FROM fs")
def fold_scores_q(spark: SparkSession, d: str) -> DataFrame:
    return R(fold_scores(_fold_frame(spark, d), _PRED_COLS))


@register("cv_score", W(*_FOLD_SQL, _LONG, _FS) + f"SELECT {cents('AVG(wmae)')} AS cv_wmae, COUNT(fold) AS n_folds FROM fs")
def cv_score_q(spark: SparkSession, d: str) -> DataFrame:
    return R(cv_score(_fold_frame(spark, d), _PRED_COLS))


@register("mae", W(*_FOLD_SQL) + f"SELECT {cents('AVG(abs(sales - fitted))')} AS mae, COUNT(*) AS n FROM fit "
          "WHERE fitted IS NOT NULL")
def mae_q(spark: SparkSession, d: str) -> DataFrame:
    return R(mae(_fold_frame(spark, d), "sales", "fitted"))


@register("lag_present", lambda: features_lag_sql())
def lag_present(spark: SparkSession, d: str) -> DataFrame:
    """Labelled feature rows whose seasonal lag is present."""
    feats = build_features(tables(spark, d), 2, 1)
    rows = rows_with_lag(feats.where(F.col("sales").isNotNull()))
    return R(rows.select(*KEY, "sales", "lag1_store_dept_sales"))


def features_lag_sql() -> str:
    ctes, body = features_sql_body(2, 1)
    return W(*ctes) + (f"SELECT store, dept, dt, {cents('sales')} AS sales, {cents('lag1_store_dept_sales')} AS lag1_store_dept_sales "
                       f"FROM ({body}) WHERE sales IS NOT NULL AND lag1_store_dept_sales IS NOT NULL")


@register("wmae", W(*_FOLD_SQL) + f"SELECT {cents('SUM(weight * abs(sales - fitted)) / SUM(weight)')} AS wmae, "
          "COUNT(*) AS n FROM fit WHERE fitted IS NOT NULL")
def wmae_q(spark: SparkSession, d: str) -> DataFrame:
    return R(wmae(_fold_frame(spark, d), "sales", "fitted", "weight"))


# --- encoding, imputation, scaling -----------------------------------------------

_ENC_COLS = ("store", "dept", "type", "is_holiday")


@register("label_encode", W(_bd(10)) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(v AS VARCHAR) AS value, "
    f"CAST(ROW_NUMBER() OVER (ORDER BY v NULLS FIRST) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT {c} AS v FROM base_data)" for c in _ENC_COLS))
def label_encode_q(spark: SparkSession, d: str) -> DataFrame:
    """Code tables fitted on history + future together (M1)."""
    bd = base_data(tables(spark, d), 10)
    _, maps = label_encode(bd.select(*_ENC_COLS), _ENC_COLS)
    parts = [m.select(F.lit(c).alias("feature"), F.col("value").cast("string").alias("value"), "code")
             for c, m in maps.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("label_decode", W(_bd(10)) + "SELECT store, dept, dt, type, is_holiday FROM base_data")
def label_decode_q(spark: SparkSession, d: str) -> DataFrame:
    """Encode then decode: the original values come back (M2)."""
    bd = base_data(tables(spark, d), 10).select("store", "dept", "dt", "type", "is_holiday")
    enc, maps = label_encode(bd, _ENC_COLS)
    return label_decode(enc, maps)


_NUM = ("temperature", "fuel_price", "cpi", "unemployment", "markdown1")


def _statistic(name: str) -> str:
    """One of the statistics in the one-row table st, as a scalar subquery."""
    return f"(SELECT {name} FROM st)"


@register("standardize", W(_bd(1), "st AS MATERIALIZED (SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in _NUM)
                           + " FROM base_data WHERE sales IS NOT NULL)")
    + "SELECT store, dept, dt, " + ", ".join(
        cents(f"({c} - {_statistic(f'm_{c}')}) / COALESCE(NULLIF({_statistic(f's_{c}')}, 0), 1)") + f" AS {c}"
        for c in _NUM) + " FROM base_data WHERE sales IS NULL")
def standardize_q(spark: SparkSession, d: str) -> DataFrame:
    """Scaling fitted on labelled rows, applied to the unlabelled ones (M3)."""
    bd = base_data(tables(spark, d), 1).select(*KEY, "sales", *_NUM)
    train, test = bd.where(F.col("sales").isNotNull()), bd.where(F.col("sales").isNull())
    _, te = standardize(train, test, _NUM)
    return R(te.select(*KEY, *_NUM))


_MD = ("markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi", "unemployment")


@register("impute_mean", W(_bd(1), "st AS MATERIALIZED (SELECT " + ", ".join(f"AVG({c}) AS m_{c}" for c in _MD)
                           + " FROM base_data WHERE sales IS NOT NULL)")
    + "SELECT store, dept, dt, " + ", ".join(f"{cents(f'COALESCE({c}, {_statistic(f'm_{c}')})')} AS {c}" for c in _MD)
    + " FROM base_data WHERE sales IS NULL")
def impute_mean_q(spark: SparkSession, d: str) -> DataFrame:
    """Training means fill the NULLs of the unlabelled rows."""
    bd = base_data(tables(spark, d), 1).select(*KEY, "sales", *_MD)
    train, test = bd.where(F.col("sales").isNotNull()), bd.where(F.col("sales").isNull())
    _, te = impute_mean(train, test, _MD)
    return R(te.select(*KEY, *_MD))


# --- feature store -----------------------------------------------------------------

@register("feature_store_roundtrip", lambda: features_sql(1, 2))
def feature_store_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """v1 features of horizons 1 and 2 written partitioned by (version,
    horizon); horizon 2 read back through partition pruning (S3, S4)."""
    path = scratch_path(spark, "features")
    feats = build_all_horizons(tables(spark, d), 1, horizons=(1, 2)).withColumn("version", F.lit(1))
    write_features(feats, path)
    return R(read_features(spark, path, 1, 2))
