"""Registered queries: scans, projections, joins, descriptive aggregates,
set operations and scalar calendar functions (S1, S2, P1-P16, J1, J2,
A1-A12, O2-O5, U1-U3, C1-C12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.cols import NA_COLUMNS, normalize_na, round_doubles, series_id
from tidecast.functions.dates import holiday_flags, row_weight, unix_seconds, week_of_month, week_us
from tidecast.operators import stats
from tidecast.operators.combine import fit_overlay, fitted_history, hier_level_means, hier_means
from tidecast.operators.joins import split_label, union_panel, warmup_cut
from tidecast.plans.catalog import register, tables
from tidecast.plans.features import BASE_COLUMNS, base_data
from tidecast.plans.oracle import base_data_cte, cents, rounded, with_fixtures
from tidecast.sources import fixtures as fx
from tidecast.sources.io import read_csv, scratch_path, write_csv

R = round_doubles
W = with_fixtures


def _bd(h: int = 1, norm: bool = False, name: str = "base_data") -> str:
    return base_data_cte(fx.end_date(h), norm, name)


# --- scans and projections ----------------------------------------------------

@register("scan_history", W() + f"SELECT store, dept, dt, {cents('sales')} AS sales FROM history")
def scan_history(spark: SparkSession, d: str) -> DataFrame:
    return R(fx.history(spark, d))


_BASE_DOUBLES = [(c, c in ("sales", "size", "temperature", "fuel_price", *NA_COLUMNS)) for c in BASE_COLUMNS]


@register("base_panel", W(_bd(1)) + f"SELECT {rounded(_BASE_DOUBLES)} FROM base_data")
def base_panel(spark: SparkSession, d: str) -> DataFrame:
    return R(base_data(tables(spark, d), 1).select(*BASE_COLUMNS))


_CTX = ["store", "dt", "temperature", "fuel_price", *NA_COLUMNS, "is_holiday"]
_CTX_SQL = ", ".join(
    [f"{cents('temperature')} AS temperature", f"{cents('fuel_price')} AS fuel_price"]
    + [f"{cents(f'CASE WHEN {c} = {chr(39)}NA{chr(39)} THEN NULL ELSE CAST({c} AS DOUBLE) END')} AS {c}"
       for c in NA_COLUMNS]
)


@register("normalize_na", W() + f"SELECT store, dt, {_CTX_SQL}, is_holiday FROM context")
def normalize_na_q(spark: SparkSession, d: str) -> DataFrame:
    return R(normalize_na(tables(spark, d).context).select(*_CTX))


@register("csv_roundtrip", W() + f"SELECT store, dt, {_CTX_SQL}, is_holiday FROM context")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Context written as CSV with literal 'NA' cells, read back with an
    explicit schema that maps 'NA' to NULL (S2, S7)."""
    path = scratch_path(spark, "context-csv")
    write_csv(tables(spark, d).context.select(*_CTX), path)
    schema = ("store int, dt date, temperature double, fuel_price double, "
              + ", ".join(f"{c} double" for c in NA_COLUMNS) + ", is_holiday boolean")
    return R(read_csv(spark, path, schema))


@register("norm_sales", W(_bd(1, norm=True)) +
          f"SELECT store, dept, dt, {cents('sales')} AS sales, {cents('size')} AS size, "
          f"{cents('norm_sales')} AS norm_sales FROM base_data")
def norm_sales(spark: SparkSession, d: str) -> DataFrame:
    return R(base_data(tables(spark, d), 1, version=4).select("store", "dept", "dt", "sales", "size", "norm_sales"))


@register("horizon_cut", W() + f"""SELECT store, dept, dt, {cents('sales')} AS sales FROM (
  SELECT store, dept, dt, sales FROM history
  UNION ALL SELECT store, dept, dt, CAST(NULL AS DOUBLE) FROM future WHERE dt <= DATE '{fx.end_date(3)}')""")
def horizon_cut(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return R(union_panel(t.history, t.future, fx.end_date(3)))


@register("union_panel", W() + f"""SELECT store, dept, dt, {cents('sales')} AS sales FROM (
  SELECT store, dept, dt, sales FROM history
  UNION ALL SELECT store, dept, dt, CAST(NULL AS DOUBLE) FROM future)""")
def union_panel_q(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return R(union_panel(t.history, t.future))


@register("warmup_cut", W(_bd(1)) + f"SELECT store, dept, dt, {cents('sales')} AS sales FROM base_data "
          f"WHERE dt >= DATE '{fx.START}'")
def warmup_cut_q(spark: SparkSession, d: str) -> DataFrame:
    return R(warmup_cut(base_data(tables(spark, d), 1), fx.START).select("store", "dept", "dt", "sales"))


_SPLIT_SQL = W(_bd(2)) + """SELECT CASE WHEN sales IS NULL THEN 'test' ELSE 'train' END AS split,
  COUNT(*) AS n_rows, COUNT(DISTINCT (store, dept)) AS n_series, MIN(dt) AS first_dt, MAX(dt) AS last_dt
FROM base_data GROUP BY 1"""


@register("split_label", _SPLIT_SQL)
def split_label_q(spark: SparkSession, d: str) -> DataFrame:
    train, test = split_label(base_data(tables(spark, d), 2))

    def summary(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("n_rows"),
                      F.count_distinct("store", "dept").alias("n_series"),
                      F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"))

    return summary(train, "train").unionByName(summary(test, "test")).where(F.col("n_rows") > 0)


@register("series_id", W() + "SELECT store, dept, dt, concat_ws('_', store, dept) AS id, "
          "concat_ws('_', store, dept, dt) AS row_id FROM history")
def series_id_q(spark: SparkSession, d: str) -> DataFrame:
    h = tables(spark, d).history
    return h.select("store", "dept", "dt", series_id("store", "dept").alias("id"),
                    series_id("store", "dept", "dt").alias("row_id"))


# --- joins ----------------------------------------------------------------------

_PANEL1 = f"""panel AS (SELECT store, dept, dt, sales FROM history
  UNION ALL SELECT store, dept, dt, CAST(NULL AS DOUBLE) FROM future WHERE dt <= DATE '{fx.end_date(1)}')"""


@register("join_stores", W(_PANEL1) + f"SELECT store, dept, dt, {cents('sales')} AS sales, type, "
          f"{cents('size')} AS size FROM panel LEFT JOIN stores USING (store)")
def join_stores(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    p = union_panel(t.history, t.future, fx.end_date(1))
    return R(p.join(t.stores, "store", "left"))


@register("join_context", W(_PANEL1) + f"SELECT store, dept, dt, {cents('sales')} AS sales, "
          f"{cents('temperature')} AS temperature, {cents('fuel_price')} AS fuel_price, "
          f"{', '.join(NA_COLUMNS)}, is_holiday FROM panel LEFT JOIN context USING (store, dt)")
def join_context(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    p = union_panel(t.history, t.future, fx.end_date(1))
    return R(p.join(t.context, ["store", "dt"], "left"))


# --- descriptive aggregates -------------------------------------------------------

@register("daily_mean", W() + f"SELECT dt, {cents('AVG(sales)')} AS mean_sales FROM history GROUP BY dt")
def daily_mean(spark: SparkSession, d: str) -> DataFrame:
    return R(stats.group_mean(tables(spark, d).history, ["dt"], ["sales"]))


@register("daily_mean_norm", W(_bd(1, norm=True)) + f"SELECT dt, {cents('AVG(norm_sales)')} AS mean_norm_sales FROM base_data "
          "WHERE sales IS NOT NULL GROUP BY dt")
def daily_mean_norm(spark: SparkSession, d: str) -> DataFrame:
    """Size-normalised mean by date (A1 on P4)."""
    bd = base_data(tables(spark, d), 1, version=4).where(F.col("sales").isNotNull())
    return R(stats.group_mean(bd, ["dt"], ["norm_sales"]))


@register("context_trend", W(_bd(10)) + f"SELECT dt, {cents('AVG(cpi)')} AS mean_cpi, "
          f"{cents('AVG(fuel_price)')} AS mean_fuel_price, {cents('AVG(unemployment)')} AS mean_unemployment "
          f"FROM base_data GROUP BY dt")
def context_trend(spark: SparkSession, d: str) -> DataFrame:
    return R(stats.group_mean(base_data(tables(spark, d), 10), ["dt"], ["cpi", "fuel_price", "unemployment"]))


@register("yoy_week_mean", W() + f"SELECT CAST(year(dt) AS INTEGER) AS year, "
          f"CAST(weekofyear(dt) AS INTEGER) AS weekofyear, {cents('AVG(sales)')} AS mean_sales "
          f"FROM history GROUP BY 1, 2")
def yoy_week_mean(spark: SparkSession, d: str) -> DataFrame:
    return R(stats.yoy_week_mean(tables(spark, d).history))


@register("series_length", W() + "SELECT store, dept, COUNT(dt) AS n_weeks FROM history GROUP BY store, dept")
def series_length(spark: SparkSession, d: str) -> DataFrame:
    return stats.series_length(tables(spark, d).history)


@register("sparse_series", W() + "SELECT store, dept, COUNT(dt) AS n_weeks FROM history GROUP BY store, dept "
          "HAVING COUNT(dt) < 20")
def sparse_series(spark: SparkSession, d: str) -> DataFrame:
    return stats.sparse_series(tables(spark, d).history)


@register("filter_series", W() + f"""SELECT h.store, h.dept, h.dt, {cents('h.sales')} AS sales FROM history h
WHERE (h.store, h.dept) IN (SELECT store, dept FROM history GROUP BY store, dept HAVING COUNT(dt) < 20)""")
def filter_series(spark: SparkSession, d: str) -> DataFrame:
    h = tables(spark, d).history
    return R(stats.rows_of(h, stats.sparse_series(h)))


_HIST_SQL = W("len AS (SELECT store, dept, COUNT(dt) AS n_weeks FROM history GROUP BY store, dept)",
              "b AS (SELECT CAST(MIN(n_weeks) AS DOUBLE) AS lo, CAST(MAX(n_weeks) AS DOUBLE) AS hi FROM len)") + \
    """SELECT bin, lo + bin * ((hi - lo) / 10) AS lo, lo + (bin + 1) * ((hi - lo) / 10) AS hi, n FROM (
  SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(floor((CAST(n_weeks AS DOUBLE) - lo) / ((hi - lo) / 10)), 9) END
              AS INTEGER) AS bin, lo, hi, COUNT(*) AS n
  FROM len, b GROUP BY 1, 2, 3)"""


@register("length_histogram", _HIST_SQL)
def length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(stats.series_length(tables(spark, d).history), "n_weeks", 10)


@register("distinct_counts", W() + """SELECT COUNT(DISTINCT store) AS n_store, COUNT(DISTINCT dept) AS n_dept,
  (SELECT COUNT(*) FROM (SELECT DISTINCT store, dept FROM history)) AS n_store_dept FROM history""")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.distinct_counts(tables(spark, d).history, ["store", "dept", ("store", "dept")])


@register("date_span", W() + """SELECT 'train' AS part, MIN(dt) AS first_dt, MAX(dt) AS last_dt, COUNT(dt) AS n_rows
FROM history UNION ALL SELECT 'test', MIN(dt), MAX(dt), COUNT(dt) FROM future""")
def date_span(spark: SparkSession, d: str) -> DataFrame:
    a = stats.date_span(tables(spark, d).history).select(F.lit("train").alias("part"), "*")
    b = stats.date_span(tables(spark, d).future).select(F.lit("test").alias("part"), "*")
    return a.unionByName(b)


# The departments and stores that the panel may have.
DEPTS = tuple(range(1, 26))
STORES = tuple(range(25))


def _pivot_sql(col: str, values, value: str = "sales", src: str = "history") -> str:
    cells = (cents(f"COALESCE(SUM(CASE WHEN {col} = {v} THEN {value} END), 0)") + f' AS "{v}"' for v in values)
    return W() + f"SELECT dt, {', '.join(cells)} FROM {src} GROUP BY dt"


@register("pivot_dept", _pivot_sql("dept", DEPTS))
def pivot_dept(spark: SparkSession, d: str) -> DataFrame:
    return R(stats.pivot_sum(tables(spark, d).history, "dt", "dept", "sales", DEPTS))


@register("pivot_store", _pivot_sql("store", STORES))
def pivot_store(spark: SparkSession, d: str) -> DataFrame:
    return R(stats.pivot_sum(tables(spark, d).history, "dt", "store", "sales", STORES))


@register("pivot_store_norm", _pivot_sql("store", STORES, "sales / size", "history LEFT JOIN stores USING (store)"))
def pivot_store_norm(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    h = t.history.join(t.stores, "store", "left").withColumn("norm_sales", F.try_divide(F.col("sales"), F.col("size")))
    return R(stats.pivot_sum(h, "dt", "store", "norm_sales", STORES))


_SEASON = ("CAST(month(dt) AS INTEGER) AS month, "
           "CAST(LEAST(floor(day(dt) / 7), 3) AS INTEGER) AS week")


@register("fit_overlay", W(f"h AS (SELECT *, {_SEASON} FROM history)",
                           "m AS (SELECT store, dept, month, week, AVG(sales) AS fitted FROM h GROUP BY ALL)") +
          f"SELECT dt, {cents('CAST(SUM(CAST(sales AS DECIMAL(38,4))) AS DOUBLE)')} AS sum_sales, "
          f"{cents('SUM(fitted)')} AS sum_fitted "
          "FROM h LEFT JOIN m USING (store, dept, month, week) GROUP BY dt")
def fit_overlay_q(spark: SparkSession, d: str) -> DataFrame:
    return R(fit_overlay(fitted_history(tables(spark, d).history)))


@register("hier_rollup", W(f"h AS (SELECT *, {_SEASON} FROM history)") + f"""SELECT
  CASE GROUPING_ID(store, dept, month, week) WHEN 0 THEN 'store_dept_month_week' WHEN 1 THEN 'store_dept_month'
       WHEN 3 THEN 'store_dept' WHEN 7 THEN 'store' END AS level,
  store, dept, month, week, {cents('AVG(sales)')} AS mean
FROM h GROUP BY GROUPING SETS ((store, dept, month, week), (store, dept, month), (store, dept), (store))""")
def hier_rollup(spark: SparkSession, d: str) -> DataFrame:
    return R(hier_means(tables(spark, d).history))


_HIER_JOIN = [
    f"h AS (SELECT *, {_SEASON} FROM history)",
    f"f AS (SELECT *, {_SEASON} FROM future)",
    "m1 AS (SELECT store, dept, month, week, AVG(sales) AS mean_store_dept_month_week FROM h GROUP BY ALL)",
    "m2 AS (SELECT store, dept, month, AVG(sales) AS mean_store_dept_month FROM h GROUP BY ALL)",
    "m3 AS (SELECT store, dept, AVG(sales) AS mean_store_dept FROM h GROUP BY ALL)",
    "m4 AS (SELECT store, AVG(sales) AS mean_store FROM h GROUP BY ALL)",
    """hj AS (SELECT f.store, f.dept, f.dt, f.month, f.week, mean_store_dept_month_week, mean_store_dept_month,
                    mean_store_dept, mean_store
  FROM f LEFT JOIN m1 USING (store, dept, month, week) LEFT JOIN m2 USING (store, dept, month)
  LEFT JOIN m3 USING (store, dept) LEFT JOIN m4 USING (store))""",
]


@register("hier_means", W(*_HIER_JOIN) + "SELECT store, dept, dt, month, week, " + ", ".join(
    f"{cents(c)} AS {c}" for c in ("mean_store_dept_month_week", "mean_store_dept_month", "mean_store_dept",
                                   "mean_store")) + " FROM hj")
def hier_means_q(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return R(hier_level_means(t.history, t.future))


@register("holiday_calendar", W(_bd(1)) + "SELECT DISTINCT dt, COALESCE(is_holiday, false) AS is_holiday "
          "FROM base_data WHERE sales IS NOT NULL")
def holiday_calendar(spark: SparkSession, d: str) -> DataFrame:
    bd = base_data(tables(spark, d), 1).where(F.col("sales").isNotNull())
    return stats.holiday_calendar(bd)


@register("holiday_weeks", W(_bd(10)) + "SELECT DISTINCT CAST(weekofyear(dt) AS INTEGER) AS weekofyear, "
          "COALESCE(is_holiday, false) AS is_holiday FROM base_data")
def holiday_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Holiday calendar by week of year over history and future."""
    bd = base_data(tables(spark, d), 10).withColumn("weekofyear", F.weekofyear("dt"))
    return stats.holiday_calendar(bd, by="weekofyear")


@register("top_series", W() + f"SELECT store, dept, {cents('AVG(sales)')} AS mean_sales FROM history "
          "GROUP BY store, dept ORDER BY AVG(sales) DESC, store, dept LIMIT 50")
def top_series(spark: SparkSession, d: str) -> DataFrame:
    """Top-50 report (the limit is the operator)."""
    m = tables(spark, d).history.groupBy("store", "dept").agg(F.avg("sales").alias("mean_sales"))
    return R(stats.top_k(m, "mean_sales", 50, ["store", "dept"]))


@register("head_history", W() + f"SELECT store, dept, dt, {cents('sales')} AS sales FROM history "
          "ORDER BY store, dept, dt LIMIT 5")
def head_history(spark: SparkSession, d: str) -> DataFrame:
    """First five rows in key order (the limit is the operator)."""
    return R(tables(spark, d).history.orderBy("store", "dept", "dt").limit(5))


@register("overlap_store", W() + """SELECT
  COUNT(*) FILTER (WHERE a AND b IS NULL) AS only_left, COUNT(*) FILTER (WHERE b AND a IS NULL) AS only_right,
  COUNT(*) FILTER (WHERE a AND b) AS both
FROM (SELECT DISTINCT store, true AS a FROM history) FULL OUTER JOIN (SELECT DISTINCT store, true AS b FROM future)
USING (store)""")
def overlap_store(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return stats.overlap(t.history, t.future, ["store"])


_OVERLAP_SQL = W() + """SELECT
  COUNT(*) FILTER (WHERE a AND b IS NULL) AS only_left, COUNT(*) FILTER (WHERE b AND a IS NULL) AS only_right,
  COUNT(*) FILTER (WHERE a AND b) AS both
FROM (SELECT DISTINCT store, dept, true AS a FROM history)
FULL OUTER JOIN (SELECT DISTINCT store, dept, true AS b FROM future) USING (store, dept)"""


@register("overlap_series", _OVERLAP_SQL)
def overlap_series(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return stats.overlap(t.history, t.future, ["store", "dept"])


_SKETCHED = {"stores": ["store"], "depts": ["dept"], "series": ["store", "dept"]}


@register("distinct_sketch", W() + """SELECT CAST(year(dt) AS INTEGER) AS year, CAST(COUNT(DISTINCT store) AS BIGINT) AS n_stores, CAST(COUNT(DISTINCT dept) AS BIGINT) AS n_depts,
  CAST(COUNT(DISTINCT store * 1000 + dept) AS BIGINT) AS n_series FROM history GROUP BY 1""")
def distinct_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Distinct counts by year, merged from sketches by (store, dept, week)."""
    h = tables(spark, d).history
    stored = stats.distinct_sketches(h, ["store", "dept", "dt"], _SKETCHED)
    return stats.merged_counts(stored.withColumn("year", F.year("dt")), list(_SKETCHED), ["year"])


@register("overlap_sketch", _OVERLAP_SQL)
def overlap_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of the series of history and future from sketches by week."""
    t = tables(spark, d)
    a, b = (stats.distinct_sketches(x, ["dt"], {"series": ["store", "dept"]}) for x in (t.history, t.future))
    return stats.sketch_overlap(a, b, "series")


@register("pivot_sparse", W() + f"""SELECT dt, CAST(COUNT(*) AS INTEGER) AS n_depts, {cents('SUM(s)')} AS total, MIN(dept) AS first_dept, MAX(dept) AS last_dept,
  {cents('MAX(s)')} AS largest FROM (SELECT dt, dept, SUM(sales) AS s FROM history GROUP BY dt, dept) GROUP BY dt""")
def pivot_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Weekly sums by department without declaring departments: figures of each week's map."""
    rows = stats.sparse_sum(tables(spark, d).history, "dt", "dept", "sales")
    keys, sums = F.map_keys("sums"), F.map_values("sums")
    return R(rows.select("dt", F.size("sums").alias("n_depts"), F.aggregate(sums, F.lit(0.0), lambda a, x: a + x).alias("total"),
                         F.array_min(keys).alias("first_dept"), F.array_max(keys).alias("last_dept"), F.array_max(sums).alias("largest")))


# --- scalar calendar functions ------------------------------------------------------

_DAYS = "days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem)"


def _ship_days(spark: SparkSession, d: str) -> DataFrame:
    return fx.read_table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("dt")).distinct()


@register("date_parts", W(_DAYS) + """SELECT dt, date_diff('day', DATE '1970-01-01', dt) * 86400 AS unixtime,
  CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, CAST(day(dt) AS INTEGER) AS day,
  CAST(strftime(dt, '%U') AS INTEGER) AS week_us, CAST(weekofyear(dt) AS INTEGER) AS weekofyear FROM days""")
def date_parts(spark: SparkSession, d: str) -> DataFrame:
    return _ship_days(spark, d).select(
        "dt", unix_seconds("dt").alias("unixtime"), F.year("dt").alias("year"), F.month("dt").alias("month"),
        F.dayofmonth("dt").alias("day"), week_us("dt").alias("week_us"), F.weekofyear("dt").alias("weekofyear"))


@register("week_of_month", W(_DAYS) + """SELECT dt, CAST(day(dt) AS INTEGER) AS day,
  CAST(LEAST(floor(day(dt) / 7), 3) AS INTEGER) AS week,
  CAST(CASE WHEN month(dt) = 12 THEN floor(day(dt) / 7) ELSE LEAST(floor(day(dt) / 7), 3) END AS INTEGER)
    AS week_dec FROM days""")
def week_of_month_q(spark: SparkSession, d: str) -> DataFrame:
    return _ship_days(spark, d).select("dt", F.dayofmonth("dt").alias("day"), week_of_month("dt").alias("week"),
                                       week_of_month("dt", clamp_december=False).alias("week_dec"))


@register("holiday_flags", W(_bd(10)) + """SELECT store, dept, dt, COALESCE(is_holiday, false) AS is_holiday,
  CAST(COALESCE(is_holiday, false) AND month = 2 AS INTEGER) AS superbowl,
  CAST(COALESCE(is_holiday, false) AND month = 11 AS INTEGER) AS thanksgiving,
  CAST(COALESCE(is_holiday, false) AND month = 12 AS INTEGER) AS christmas FROM base_data""")
def holiday_flags_q(spark: SparkSession, d: str) -> DataFrame:
    bd = base_data(tables(spark, d), 10)
    out = holiday_flags(bd)
    return out.select("store", "dept", "dt", F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
                      "superbowl", "thanksgiving", "christmas")


@register("row_weight", W(_bd(1)) + "SELECT store, dept, dt, "
          "CAST(COALESCE(is_holiday, false) AS INTEGER) * 4 + 1 AS weight FROM base_data")
def row_weight_q(spark: SparkSession, d: str) -> DataFrame:
    return base_data(tables(spark, d), 1).select("store", "dept", "dt", row_weight().alias("weight"))
