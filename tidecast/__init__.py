"""tidecast: weekly sales-panel features, baseline forecasts and forecast
combination, expressed as Spark DataFrame plans.

Layout
------
sources/    derived panel tables and file sinks/scans
functions/  Column-level helpers (dates, NA normalisation, ids)
operators/  DataFrame -> DataFrame building blocks (joins, windows, stats,
            forecast combination, metrics, folds, encoding)
plans/      composed plans: feature sets per version/horizon, model CV,
            the registered query catalogue and its DuckDB oracles
"""

__all__ = ["session"]
