"""Column helpers: NA normalisation, ids, rounding for cross-engine checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Context columns that arrive as strings with literal 'NA'.
NA_COLUMNS = ("markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi", "unemployment")


def na_to_double(c: str) -> Column:
    """'NA' -> NULL, else a strict cast.

    ANSI casts stay on, so any other garbage still fails loudly.
    """
    return F.nullif(F.col(c), F.lit("NA")).cast("double")


def normalize_na(df: DataFrame, cols=NA_COLUMNS) -> DataFrame:
    return df.withColumns({c: na_to_double(c) for c in cols})


def series_id(*cols: str | Column) -> Column:
    """'store_dept[_date]' identifier."""
    return F.concat_ws("_", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def parse_submission_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Split 'store_dept_date' back into typed parts."""
    parts = F.split(F.col(id_col), "_")
    return df.withColumns(
        {
            "store": F.element_at(parts, 1).cast("int"),
            "dept": F.element_at(parts, 2).cast("int"),
            "dt": F.to_date(F.element_at(parts, -1)),
        }
    )


def cents(c: str | Column) -> Column:
    """Tie-safe rounding to 0.01 used on both sides of the oracle check.

    Engines differ by ~1e-10 after long sums; floor(x*100 + 0.5 + 1e-6)
    moves the rounding boundary away from exact half-cents.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * F.lit(100.0) + F.lit(0.5 + 1e-6)) / F.lit(100.0)


def round_doubles(df: DataFrame, exclude=()) -> DataFrame:
    """Apply :func:`cents` to every double column."""
    return df.select(
        *[
            cents(f.name).alias(f.name) if f.dataType.typeName() == "double" and f.name not in exclude else F.col(f.name)
            for f in df.schema.fields
        ]
    )
