"""Error metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wmae(df: DataFrame, y: str = "sales", p: str = "pred", w: str = "weight") -> DataFrame:
    """Weighted MAE: sum(w * |y - p|) / sum(w) over rows with a prediction."""
    d = df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
    return d.agg((F.sum(F.col(w) * F.abs(F.col(y) - F.col(p))) / F.sum(w)).alias("wmae"),
                 F.count(F.lit(1)).alias("n"))


def mae(df: DataFrame, y: str = "sales", p: str = "pred") -> DataFrame:
    """Plain MAE."""
    d = df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
    return d.agg(F.avg(F.abs(F.col(p) - F.col(y))).alias("mae"), F.count(F.lit(1)).alias("n"))


def fold_scores(df: DataFrame, pred_cols: Sequence[str], y: str = "sales", w: str = "weight") -> DataFrame:
    """wMAE of each fold's prediction column over the rows it predicts."""
    stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("fold"), F.col(c).alias("_p"))
                                  for i, c in enumerate(pred_cols)])).alias("_s")
    long = df.select(y, w, stacked).select(y, w, "_s.fold", "_s._p").where(F.col("_p").isNotNull())
    return long.groupBy("fold").agg(
        (F.sum(F.col(w) * F.abs(F.col(y) - F.col("_p"))) / F.sum(w)).alias("wmae"),
        F.count(F.lit(1)).alias("n"),
    )


def cv_score(df: DataFrame, pred_cols: Sequence[str], y: str = "sales", w: str = "weight") -> DataFrame:
    """Unweighted mean of the per-fold wMAE."""
    return fold_scores(df, pred_cols, y, w).agg(F.avg("wmae").alias("cv_wmae"), F.count("fold").alias("n_folds"))
