"""Forecast models with time hold-out CV.

Training frames come from the feature plans, written once to the shared
checkpoint folder, so a lost executor rereads them rather than the raw scans.
Boosted trees are :mod:`tidecast.operators.boosting`: all horizons and folds of
a feature version are fitted together.  Ridge fits come from sums of products
that one pass collects (:mod:`tidecast.operators.ridge`).  The driver holds fitted
coefficients, trees and one line for each fold.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.dates import holiday_flags, row_weight, with_date_parts
from tidecast.operators import boosting as B
from tidecast.operators import ridge as RG
from tidecast.operators.encode import code_tables, impute_mean, standardize
from tidecast.operators.folds import holdout_folds
from tidecast.operators.joins import rows_with_lag
from tidecast.plans.features import CATEGORICAL, LAG, build_all_horizons, feature_columns
from tidecast.session import ensure_checkpoint_dir
from tidecast.sources.io import scratch_path, write_predictions
from tidecast.sources.panel import PanelTables

KEY = ["store", "dept", "dt"]
LABEL = "sales"
N_FOLDS = 3
FOLDS = [f"valid_{i}" for i in range(N_FOLDS)]
BOOSTER = B.Settings()
RIDGE_ALPHAS = tuple(float(a) for a in np.linspace(0.0, 1.0, 10))


def training_frame(features: DataFrame) -> DataFrame:
    """Date parts, holiday flags and row weights of the training drivers.

    ``week`` becomes the week of month here, as in training (the SQL-side
    Sunday week is only a window partition key).
    """
    df = with_date_parts(features)
    df = holiday_flags(df)
    return df.withColumn("weight", row_weight())


def _checkpoint(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _written(df: DataFrame) -> DataFrame:
    """Materialise as a table of the shared folder, of which later steps read single columns."""
    path = scratch_path(df.sparkSession, "fit-rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spread(df: DataFrame) -> DataFrame:
    """Dealt over all cores where a materialised frame has fewer partitions:
    sketches of many columns cost far more than the bytes that AQE goes by."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass
class CVResult:
    valid: DataFrame            # store, dept, dt, fold, sales, weight, pred (validation rows)
    test: DataFrame             # store, dept, dt, fold, pred (every unlabelled row, per fold)
    models: dict = field(default_factory=dict)
    info: list = field(default_factory=list)


@dataclass
class Boosted:
    """Boosters of one feature version: a fit for each horizon, three folds each."""

    version: int
    bins: B.Bins
    nodes: DataFrame          # boosting.NODES; fit is the horizon
    train: DataFrame          # chunks of labelled rows
    test: DataFrame           # chunks of unlabelled rows

    def _long(self, chunks: DataFrame, labelled: bool, nodes: DataFrame | None = None) -> DataFrame:
        wide = B.predict(chunks, self.nodes if nodes is None else nodes, self.bins, N_FOLDS, KEY)
        each = F.inline(F.array(*[F.struct(F.lit(i).alias("fold"), F.col(f"valid_{i}").alias("_valid"), F.col(f"pred_{i}").alias("pred")) for i in range(N_FOLDS)]))
        if not labelled:
            return wide.select(F.col("fit").alias("horizon"), *KEY, each).drop("_valid")
        rows = wide.select(F.col("fit").alias("horizon"), *KEY, F.col("label").alias(LABEL), "weight", each)
        return rows.where("_valid").drop("_valid")

    def valid_rows(self) -> DataFrame:
        """horizon, store, dept, dt, sales, weight, fold, pred of the rows that a fold validates."""
        return self._long(self.train, True)

    def test_rows(self, nodes: DataFrame | None = None) -> DataFrame:
        """horizon, store, dept, dt, fold, pred of every unlabelled row."""
        return self._long(self.test, False, nodes)

    def info(self) -> list[dict]:
        """Best round, its validation error and the rounds tried, by horizon and fold."""
        last = self.nodes.where("node = 0").groupBy("fit", "fold").agg(F.max(F.struct("tree", "error", "rounds")).alias("x"))
        rows = last.select("fit", "fold", (F.col("x.tree") + 1).alias("best_iter"), F.col("x.error").alias("valid_mae"), F.col("x.rounds").alias("rounds"))
        return [r.asDict() for r in rows.orderBy("fit", "fold").collect()]

    def cv(self) -> CVResult:
        """The folds of a single horizon, as the ridge path returns them."""
        info = [{k: v for k, v in i.items() if k != "fit"} for i in self.info()]
        models = {i: self.nodes.where(F.col("fold") == i) for i in range(N_FOLDS)}
        return CVResult(valid=self.valid_rows().drop("horizon"), test=self.test_rows().drop("horizon"), models=models, info=info)


def fit_boosted(features: DataFrame, version: int, **overrides) -> Boosted:
    """Boosters for every value of the column ``horizon`` of ``features`` and
    every hold-out fold (M6, M7).  ``overrides`` replace booster settings,
    e.g. ``learning_rate=0.01`` for the slow variant."""
    settings = replace(BOOSTER, **overrides)
    cols, cats = feature_columns(version), CATEGORICAL[version]
    frame = training_frame(features).withColumnRenamed("horizon", "fit")
    numeric = [c for c in cols if c not in cats]
    # The feature plan runs once: codes, bins and chunks read this table, each only the columns that it needs.
    df = _spread(_written(frame.select("fit", *dict.fromkeys([*KEY, LABEL, "weight", *cats]), B.pack(numeric))))
    for c, codes in code_tables(df, cats).items():
        df = df.join(codes.withColumnRenamed("code", f"code_{c}"), df[c].eqNullSafe(codes["value"]), "left").drop("value")
    train = holdout_folds(df.where(F.col(LABEL).isNotNull()), N_FOLDS)
    bins = B.quantile_bins(train, numeric, [f"code_{c}" for c in cats])
    chunks = B.write_chunks(train, bins, KEY, LABEL, "weight", FOLDS, packed=numeric)
    test = B.write_chunks(df.where(F.col(LABEL).isNull()), bins, KEY, None, None, packed=numeric)
    return Boosted(version, bins, B.fit_boosters(chunks, N_FOLDS, bins, settings), chunks, test)


def fit_gbt_cv(features: DataFrame, version: int, **overrides) -> CVResult:
    """Weighted squared-loss boosted trees of one horizon, one model per
    hold-out fold, each stopped early on its validation rows (M6, M7)."""
    return fit_boosted(features.withColumn("horizon", F.lit(0)), version, **overrides).cv()


def importance(fits: Boosted) -> DataFrame:
    """Raw gain of every feature summed over a fold's trees: mean and
    population std over folds, largest first (M10, A16, O3)."""
    imp = B.gains(fits.nodes, fits.bins.columns, N_FOLDS)
    return imp.select(F.regexp_replace("feature", "^code_", "").alias("feature"), "mean", "std").orderBy(F.col("mean").desc(), "feature")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def ridge_columns(version: int) -> list[str]:
    return [c for c in feature_columns(version) if c not in CATEGORICAL[version] and c != "superbowl"]


def ridge_frames(features: DataFrame, version: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """(labelled rows with folds, unlabelled rows, feature columns): rows
    without the seasonal lag are dropped from the labelled ones, every feature
    is mean-imputed and standardised with the labelled rows' statistics."""
    cols = ridge_columns(version)
    keep = list(dict.fromkeys([*KEY, LABEL, "weight", LAG, *cols]))
    # The feature plan runs once: imputation/scaling statistics and fits read this.
    df = _checkpoint(training_frame(features).select(*keep))
    train = rows_with_lag(df.where(F.col(LABEL).isNotNull()), LAG)
    test = df.where(F.col(LABEL).isNull())
    train, test = impute_mean(train, test, cols)
    train, test = standardize(train, test, cols)
    return holdout_folds(train, N_FOLDS), test, cols


def fit_ridge_cv(features: DataFrame, version: int = 2, alphas=RIDGE_ALPHAS) -> CVResult:
    """Ridge per fold with the penalty picked on validation MAE, ties to the
    larger penalty (M9, M11): one pass collects the sums of products of each
    fold's ring of dates, one more the errors of all folds and penalties."""
    train, test, cols = ridge_frames(features, version)
    train = _checkpoint(train)
    sums = RG.gram(train, cols, LABEL, N_FOLDS)
    grid = {n: RG.solve(sums, n, alphas) for n in range(N_FOLDS)}
    errors = RG.grid_errors(train, cols, LABEL, FOLDS, grid)
    res = CVResult(valid=None, test=None)
    for n in range(N_FOLDS):
        chosen = min(range(len(alphas)), key=lambda i: (errors[n][i], -i))
        res.models[n] = grid[n][chosen]
        res.info += [{"fold": n, "alpha": float(a), "mae": errors[n][i], "chosen": i == chosen} for i, a in enumerate(alphas)]
    valid = train.select(*KEY, LABEL, "weight", F.inline(F.array(*[F.struct(F.lit(n).alias("fold"), F.col(f"valid_{n}").alias("_in"), m.value(cols).alias("pred")) for n, m in res.models.items()])))
    res.valid = valid.where("_in").drop("_in")
    res.test = test.select(*KEY, F.inline(F.array(*[F.struct(F.lit(n).alias("fold"), m.value(cols).alias("pred")) for n, m in res.models.items()])))
    return res


def fold_average(test_preds: DataFrame) -> DataFrame:
    """Final forecast: mean of the fold models (M8)."""
    return test_preds.groupBy(*KEY).agg(F.avg("pred").alias("pred"), F.count("pred").alias("n_folds"))


def save_nodes(nodes: DataFrame, path: str) -> str:
    """Persist fitted boosters, one folder per fold."""
    nodes.write.mode("overwrite").partitionBy("fold").parquet(path)
    return path


def load_nodes(spark: SparkSession, path: str) -> DataFrame:
    names = [x.split()[0] for x in B.NODES.split(", ")]
    return spark.read.schema(B.NODES).parquet(path).select(*names)


def train_predictions(valid: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Training-side predictions: a row for each labelled key that some fold
    validates, with a column for each fold (S5)."""
    wide = valid.groupBy(*by, *KEY, LABEL, "weight").pivot("fold", list(range(N_FOLDS))).agg(F.first("pred"))
    return wide.select(*by, *KEY, LABEL, "weight", *[F.col(str(i)).alias(f"pred_fold{i}") for i in range(N_FOLDS)])


def fit_horizons(tables: PanelTables, version: int, horizons: Iterable[int] | None = None, **overrides) -> Boosted:
    """Boosters of all horizons, from one table of their features (trailing frames computed once, looked up by each horizon)."""
    horizons = list(horizons or tables.calendar.horizons)
    return fit_boosted(build_all_horizons(tables, version, horizons, method="shift"), version, **overrides)


def ridge_horizons(tables: PanelTables, version: int, horizons: Iterable[int] | None = None) -> DataFrame:
    """The ridge path over horizons: store, dept, dt, horizon, pred."""
    horizons = list(horizons or tables.calendar.horizons)
    path = scratch_path(tables.history.sparkSession, "ridge-features")
    build_all_horizons(tables, version, horizons).write.partitionBy("horizon").parquet(path)
    feats = tables.history.sparkSession.read.parquet(path)
    fits = {h: fit_ridge_cv(feats.where(F.col("horizon") == h).drop("horizon"), version) for h in horizons}
    return _union([fold_average(res.test).select(*KEY, F.lit(h).alias("horizon"), "pred") for h, res in fits.items()])


def forecast_horizons(tables: PanelTables, version: int, kind: str = "gbt", horizons: Iterable[int] | None = None, **overrides) -> DataFrame:
    """Per-horizon CV fits and the long forecast table (store, dept, dt,
    horizon, pred) that the combination operators take."""
    if kind == "ridge":
        return ridge_horizons(tables, version, horizons)
    rows = fit_horizons(tables, version, horizons, **overrides).test_rows()
    return rows.groupBy("horizon", *KEY).agg(F.avg("pred").alias("pred")).select(*KEY, "horizon", "pred")


def write_horizon_predictions(fits: Boosted, model: str, path: str) -> None:
    """Both sides of every horizon: test forecasts and training predictions
    per fold, partitioned by (model, horizon, split) (S5)."""
    tests = fits.test_rows().groupBy("horizon", *KEY).agg(F.avg("pred").alias("pred"))
    trains = train_predictions(fits.valid_rows(), ["horizon"])
    write_predictions(tests.withColumns({"model": F.lit(model), "split": F.lit("test")}), path)
    write_predictions(trains.withColumns({"model": F.lit(model), "split": F.lit("train")}), path)
