"""Panel tables derived from the TPC-H-style test tables.

Mapping (see FIXTURES.md): store = nation of the supplier, department =
brand number, week = Monday of the ship week, sales = exact decimal revenue
sum cast to double.  Orders per (customer nation, order week) play the
time-varying context table; supplier counts per nation play the store
dimension.  Every table is a lazy DataFrame over the parquet scans, so its
cost grows with the input.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import ensure_checkpoint_dir
from tidecast.sources.panel import Calendar, PanelTables

# Fixed calendar of the derived panel (values that must agree with the
# oracle SQL): history ends before the cut-off, the future holds 39 weeks.
CUTOFF = dt.date(2001, 2, 5)          # first unlabelled week
FIRST_WEEK = dt.date(1995, 1, 2)      # first week of the panel
WARMUP_DAYS = 84                      # 3 x 28 days skipped after FIRST_WEEK
MONTH_DAYS = 28                       # one forecast "month"
HORIZONS = tuple(range(1, 11))        # forecast horizons in months

START = FIRST_WEEK + dt.timedelta(days=WARMUP_DAYS)
CALENDAR = Calendar(cutoff=CUTOFF, start=START, month_days=MONTH_DAYS, horizons=HORIZONS)

# The future holiday week (ISO week 36) and the week after it,
# the pair the date post-processing (scale / redistribute) acts on.
POST_WEEKS = (dt.date(2001, 9, 3), dt.date(2001, 9, 10))


def end_date(horizon: int) -> dt.date:
    """Last future date visible to the feature set of ``horizon``."""
    return CALENDAR.end_date(horizon)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _week(ts: Column) -> Column:
    return F.to_date(F.date_trunc("week", ts))


def sales_all(spark: SparkSession, sf_dir: str, before: dt.date | None = None, since: dt.date | None = None) -> DataFrame:
    """Weekly revenue per (store, dept, dt), history and future together.

    Line items are joined to the part and supplier dimensions (AQE
    broadcasts a small one and splits skewed partitions of a shuffled one)
    and aggregated once; the map-side combine of that aggregation is what
    reduces the rows.  Decimal sums keep the result exact, hence independent
    of the aggregation order.  ``before`` and ``since`` must be Mondays: the
    week's cut-off is then a plain predicate on the ship date, which reaches
    the scan.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount")
    for day, keep in ((before, F.col("l_shipdate") < F.lit(before)), (since, F.col("l_shipdate") >= F.lit(since))):
        if day is not None:
            if day.weekday():
                raise ValueError(f"{day} is not a Monday")
            li = li.where(keep)
    rev = (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).cast("decimal(18,4)")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.substring("p_brand", 7, 100).cast("int").alias("dept")
    )
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("store"))
    joined = li.join(part, li.l_partkey == part.p_partkey).join(supp, li.l_suppkey == supp.s_suppkey)
    return joined.groupBy("store", "dept", _week(F.col("l_shipdate")).alias("dt")).agg(F.sum(rev).cast("double").alias("sales"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_all(spark, sf_dir, before=CUTOFF)


def future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_all(spark, sf_dir, since=CUTOFF).select("store", "dept", "dt")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension: one row per nation that has suppliers."""
    sup = read_table(spark, sf_dir, "supplier").select("s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    kind = (
        F.when(F.col("n_regionkey") <= 1, "A").when(F.col("n_regionkey") <= 3, "B").otherwise("C")
    )
    return (
        sup.join(nat, sup.s_nationkey == nat.n_nationkey)
        .groupBy(F.col("s_nationkey").alias("store"))
        .agg(F.min(kind).alias("type"), F.count(F.lit(1)).alias("_n"))
        .select(
            "store",
            "type",
            (F.lit(1000) + F.lit(10000) * F.col("_n") + F.lit(100) * F.col("store")).cast("double").alias("size"),
        )
    )


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-varying store context with the 'NA' strings of the raw CSV form.

    Orders are joined to the customer dimension and aggregated once per
    (store, week).
    """
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("store"))
    week = _week(F.col("o_orderdate"))
    base = orders.join(cust, orders.o_custkey == cust.c_custkey).withColumns({"dt": week, "amount": F.col("o_totalprice").cast("decimal(18,2)")})
    n = F.count(F.lit(1))
    n_cust = F.count_distinct("o_custkey")
    sums = [F.sum(F.when(F.col("o_orderpriority").startswith(f"{i}-"), F.col("amount"))) for i in range(1, 6)]
    markdowns = [F.coalesce(x.cast("string"), F.lit("NA")).alias(f"markdown{i}") for i, x in enumerate(sums, 1)]
    return base.groupBy("store", "dt").agg(
        n.cast("double").alias("temperature"),
        F.min("o_totalprice").alias("fuel_price"),
        *markdowns,
        F.when(n < 2, F.lit("NA")).otherwise(F.max("o_totalprice").cast("decimal(18,2)").cast("string")).alias("cpi"),
        F.when(n_cust < 2, F.lit("NA")).otherwise(n_cust.cast("string")).alias("unemployment"),
        F.max(F.weekofyear("dt")).isin(6, 36, 47, 52).alias("is_holiday"),
    )


_MATERIALIZED: dict = {}


def _listing(spark: SparkSession, sf_dir: str) -> tuple:
    """Files of the source tables with their lengths and times of change."""
    out = []
    for name in ("lineitem", "part", "supplier", "nation", "orders", "customer"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def load_panel_tables(spark: SparkSession, sf_dir: str, materialize: bool = False) -> PanelTables:
    """The four input tables of the feature plans.

    With ``materialize`` the derived tables are written once per session and
    state of the input files as Parquet under the shared checkpoint folder
    and read back: every later plan starts from the small weekly panel
    instead of re-deriving it from the raw line items (one raw scan instead
    of one per branch), lineage is cut at that point, and the reads get
    column pruning and pushed-down date filters.
    """
    if not materialize:
        return PanelTables(
            history=history(spark, sf_dir),
            future=future(spark, sf_dir),
            stores=stores(spark, sf_dir),
            context=context(spark, sf_dir),
            calendar=CALENDAR,
        )
    key = (spark.sparkContext.applicationId, sf_dir)
    files = _listing(spark, sf_dir)
    known = _MATERIALIZED.get(key)
    if known is None or known[0] != files:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/panel-{uuid.uuid4().hex[:12]}"
        paths = {}
        for name, fn in (("sales_all", sales_all), ("stores", stores), ("context", context)):
            paths[name] = f"{root}/{name}"
            fn(spark, sf_dir).write.mode("overwrite").parquet(paths[name])
        known = _MATERIALIZED[key] = (files, paths)
    paths = known[1]
    sales = spark.read.parquet(paths["sales_all"])
    return PanelTables(
        history=sales.where(F.col("dt") < F.lit(CUTOFF)),
        future=sales.where(F.col("dt") >= F.lit(CUTOFF)).select("store", "dept", "dt"),
        stores=spark.read.parquet(paths["stores"]),
        context=spark.read.parquet(paths["context"]),
        calendar=CALENDAR,
    )
