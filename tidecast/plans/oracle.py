"""DuckDB oracle SQL for the registered queries.

Only the raw tables are registered as views on the oracle side, so every
statement starts with the derived panel tables (FIXTURES.md) as CTEs.  The
feature SQL uses direct RANGE windows for every level over the base data, so
it checks the pre-aggregated rollups and the shifted frames.
"""

from __future__ import annotations

import datetime as dt

from tidecast.functions.cols import NA_COLUMNS
from tidecast.operators.windows import LEVELS, OPS, SPANS, feature_name
from tidecast.sources.fixtures import CUTOFF, HORIZONS, MONTH_DAYS, START, end_date

_MARKDOWNS = ",\n".join(
    f"  COALESCE(CAST(SUM(CASE WHEN o_orderpriority LIKE '{i}-%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END)"
    f" AS VARCHAR), 'NA') AS markdown{i}"
    for i in range(1, 6)
)

SALES_ALL_SQL = """SELECT s_nationkey AS store, CAST(substr(p_brand, 7) AS INTEGER) AS dept,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS dt,
         CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS sales
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2, 3"""

HISTORY_SQL = f"SELECT * FROM ({SALES_ALL_SQL}) WHERE dt < DATE '{CUTOFF}'"

STORES_SQL = """SELECT s_nationkey AS store,
         MIN(CASE WHEN n_regionkey <= 1 THEN 'A' WHEN n_regionkey <= 3 THEN 'B' ELSE 'C' END) AS type,
         CAST(1000 + 10000 * COUNT(*) + 100 * s_nationkey AS DOUBLE) AS size
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY s_nationkey"""

FIXTURE_CTES = f"""
sales_all AS MATERIALIZED ({SALES_ALL_SQL}),
history AS (SELECT * FROM sales_all WHERE dt < DATE '{CUTOFF}'),
future AS (SELECT store, dept, dt FROM sales_all WHERE dt >= DATE '{CUTOFF}'),
stores AS MATERIALIZED ({STORES_SQL}),
context AS MATERIALIZED (
  SELECT store, dt, CAST(COUNT(*) AS DOUBLE) AS temperature, MIN(o_totalprice) AS fuel_price,
{_MARKDOWNS},
  CASE WHEN COUNT(*) < 2 THEN 'NA' ELSE CAST(CAST(MAX(o_totalprice) AS DECIMAL(18,2)) AS VARCHAR) END AS cpi,
  CASE WHEN COUNT(DISTINCT o_custkey) < 2 THEN 'NA' ELSE CAST(COUNT(DISTINCT o_custkey) AS VARCHAR) END AS unemployment,
  MAX(EXTRACT(WEEK FROM dt)) IN (6, 36, 47, 52) AS is_holiday
  FROM (SELECT c_nationkey AS store, CAST(date_trunc('week', o_orderdate) AS DATE) AS dt,
               o_totalprice, o_orderpriority, o_custkey
        FROM orders JOIN customer ON o_custkey = c_custkey)
  GROUP BY store, dt
)"""


def with_fixtures(*ctes: str) -> str:
    """``WITH <fixture views>, <extra ctes>`` prefix."""
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def cents(expr: str) -> str:
    return f"floor(({expr}) * 100.0 + {0.5 + 1e-6!r}) / 100.0"


def rounded(cols_and_doubles: list[tuple[str, bool]], alias: str | None = None) -> str:
    pre = f"{alias}." if alias else ""
    return ", ".join(
        f"{cents(pre + c)} AS {c}" if is_double else f"{pre}{c}" for c, is_double in cols_and_doubles
    )


def _na(c: str) -> str:
    return f"CASE WHEN c.{c} = 'NA' THEN NULL ELSE CAST(c.{c} AS DOUBLE) END AS {c}"


def base_data_cte(end: dt.date | None, norm: bool, name: str = "base_data") -> str:
    fut = "SELECT store, dept, dt, CAST(NULL AS DOUBLE) AS sales FROM future"
    if end is not None:
        fut += f" WHERE dt <= DATE '{end}'"
    norm_col = "p.sales / s.size AS norm_sales," if norm else ""
    return f"""{name} AS MATERIALIZED (
  SELECT p.store, p.dept, p.dt, CAST(month(p.dt) AS INTEGER) AS month,
         CAST(strftime(p.dt, '%U') AS INTEGER) AS week,
         date_diff('day', DATE '1970-01-01', p.dt) * 86400 AS unixtime,
         c.is_holiday, p.sales, {norm_col} s.type, s.size, c.temperature, c.fuel_price,
         {", ".join(_na(c) for c in NA_COLUMNS)}
  FROM (SELECT store, dept, dt, sales FROM history UNION ALL {fut}) p
  LEFT JOIN stores s USING (store)
  LEFT JOIN context c USING (store, dt)
)"""


_SQL_OP = {"avg": "AVG", "stddev": "STDDEV_SAMP", "min": "MIN", "max": "MAX"}


def range_frame(keys, lo_days: int | None, hi_days: int) -> str:
    lo = "UNBOUNDED PRECEDING" if lo_days is None else f"INTERVAL {lo_days} DAY PRECEDING"
    return (f"OVER (PARTITION BY {', '.join(keys)} ORDER BY dt "
            f"RANGE BETWEEN {lo} AND INTERVAL {hi_days} DAY PRECEDING)")


def window_select(version: int, base: int) -> list[str]:
    values = ["sales", "norm_sales"] if version >= 4 else ["sales"]
    out = []
    for value in values:
        for keys in LEVELS:
            for span_name, span in SPANS.items():
                for op in OPS:
                    out.append(f"{_SQL_OP[op]}({value}) {range_frame(keys, span + base, base)} "
                               f"AS {feature_name(value, op, keys, span_name)}")
    if version >= 4:
        out.append(f"AVG(sales) {range_frame(('store', 'dept', 'week'), None, base)} "
                   f"AS sales_avg_by_store_dept_week")
        out.append(f"AVG(norm_sales) {range_frame(('store', 'dept', 'week'), None, base)} "
                   f"AS norm_sales_avg_by_store_dept_week")
    return out


def features_sql_body(version: int, horizon: int, start: dt.date = START, tag: str = "") -> tuple[list[str], str]:
    """(ctes, select) of one version/horizon feature set: direct RANGE windows
    for every level in one pass over the base data, differences on top."""
    base = MONTH_DAYS * horizon
    b, t = f"base_data{tag}", f"target{tag}"
    wins = window_select(version, base)
    if version >= 2:
        wins.append(f"FIRST_VALUE(sales) {range_frame(('store', 'dept', 'month', 'week'), None, base)} AS lag1_store_dept_sales")
    ctes = [
        base_data_cte(end_date(horizon), version >= 4, b),
        f"{t} AS MATERIALIZED (SELECT {b}.*, " + ",\n  ".join(wins) + f" FROM {b})",
    ]
    diffs = ""
    if version >= 3:
        diffs = ", " + ", ".join(
            f"{feature_name('sales', 'avg', k, s)} - lag1_store_dept_sales AS diff_{feature_name('sales', 'avg', k, s)}"
            for k in LEVELS for s in SPANS
        )
    return ctes, f"SELECT {t}.*{diffs} FROM {t} WHERE dt >= DATE '{start}'"


def feature_doubles(version: int) -> list[tuple[str, bool]]:
    from tidecast.plans.features import output_columns

    ints = {"store", "dept", "dt", "month", "week", "unixtime", "is_holiday", "type"}
    return [(c, c not in ints) for c in output_columns(version)]


def features_sql(version: int, horizon: int) -> str:
    ctes, inner = features_sql_body(version, horizon)
    return with_fixtures(*ctes, f"feat AS ({inner})") + f"SELECT {rounded(feature_doubles(version))} FROM feat"


def features_all_horizons_sql(version: int, horizons=HORIZONS) -> str:
    ctes, arms = [], []
    for h in horizons:
        c, inner = features_sql_body(version, h, tag=f"_h{h}")
        ctes += c
        ctes.append(f"feat_h{h} AS ({inner})")
        arms.append(f"SELECT {rounded(feature_doubles(version))}, {h} AS horizon FROM feat_h{h}")
    return with_fixtures(*ctes) + "\nUNION ALL\n".join(arms)


def horizon_sums_sql(version: int) -> str:
    """:func:`features_all_horizons_sql` summed by series and horizon."""
    sums = ", ".join(f"CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DOUBLE) AS {c}" for c, is_double in feature_doubles(version) if is_double)
    return (f"SELECT store, dept, horizon, COUNT(*) AS n_rows, {sums} FROM ({features_all_horizons_sql(version)}) "
            "GROUP BY store, dept, horizon")
