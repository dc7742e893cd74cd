"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Every builder reads the given tables through :mod:`tidecast.sources.fixtures`
and returns a lazy DataFrame; double columns are rounded with
:func:`tidecast.functions.cols.cents` so the two engines can be compared
value by value.  Entries without SQL get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.cols import round_doubles
from tidecast.plans import oracle as O
from tidecast.plans.features import build_all_horizons, build_features
from tidecast.sources.fixtures import load_panel_tables

Builder = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn: Builder) -> Builder:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, Builder]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: (v() if callable(v) else v) for k, v in _SQL.items()}


def tables(spark: SparkSession, sf_dir: str):
    """Derived panel tables, materialised once per session (see
    :func:`tidecast.sources.fixtures.load_panel_tables`)."""
    return load_panel_tables(spark, sf_dir, materialize=True)


# --- feature sets (M12) -----------------------------------------------------

def _features(version: int, horizon: int) -> Builder:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(build_features(tables(spark, sf_dir), version, horizon))

    return run


for _v in (1, 2, 3, 4):
    register(f"features_v{_v}", (lambda v=_v: O.features_sql(v, 1)))(_features(_v, 1))

register("features_h10", lambda: O.features_sql(4, 10))(_features(4, 10))


@register("features_all_horizons", lambda: O.features_all_horizons_sql(3))
def features_all_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(build_all_horizons(tables(spark, sf_dir), 3))


def _all_horizons(version: int) -> Builder:
    """All rows and columns of a version's ten feature sets, summed by series
    and horizon: rounded values add up exactly as decimals, so a sum differs
    if any value does, and ten full tables needn't be compared row by row."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = round_doubles(build_all_horizons(tables(spark, sf_dir), version))
        doubles = [c for c, is_double in O.feature_doubles(version) if is_double]
        sums = [F.sum(F.col(c).cast("decimal(38,2)")).cast("double").alias(c) for c in doubles]
        return df.groupBy("store", "dept", "horizon").agg(F.count(F.lit(1)).alias("n_rows"), *sums)

    return run


for _v in (1, 2, 4):
    register(f"features_all_horizons_v{_v}", (lambda v=_v: O.horizon_sums_sql(v)))(_all_horizons(_v))


# Query modules register themselves on import.
from tidecast.plans import eda_queries, forecast_queries, model_queries  # noqa: E402,F401
