"""Registered queries against their DuckDB oracles at sf0.001 (a subset
per family; tools/check_oracle.py runs the whole catalogue)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

NAMES = [
    "features_v1", "features_v3", "features_h10", "target_store", "target_dept", "seasonal_first",
    "base_panel", "csv_roundtrip", "pivot_dept", "hier_rollup", "hier_means", "length_histogram",
    "overlap_series", "date_parts", "hier_forecast", "horizon_wide", "horizon_first", "blend_models",
    "xmas_redistribute", "rolling2", "fold_mean", "cv_score", "label_encode", "standardize",
    "horizon_long", "submission_parse", "features_all_horizons_v2", "pivot_store_norm", "impute_mean", "mae", "lag_present",
    "forecast_vs_actual", "horizon_mean_spine", "daily_mean_norm", "holiday_weeks", "split_label", "holdout_folds",
    "length_histogram", "label_decode", "scan_history", "feature_store_roundtrip", "gbt_root_splits", "ridge_gram",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_builder_and_names():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 70


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "sales_avg_by_store_half_year" in df.columns
