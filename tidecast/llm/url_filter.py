"""URL filter: rules first, then a character language-model ratio.

Rules (host, path) decide the urls that they fit; the longest wins.  All
other urls are judged by two smoothed variable-order Markov models over the
bytes of a url, one for accepted and one for rejected urls.  Both are fitted
on every url that a rule decides: exact next-byte counts after contexts of 0
to ``ORDER`` bytes, kept in Spark tables that grow with the urls.  A context
and its next byte are numbered exactly in a long, lower orders are sums over
the first byte, and each distinct one gets its log ratio by joins.  The most
frequent ones, at most ``FREQUENT``, are looked up from a broadcast; all others
are joined to the urls by shuffle, so no key of that join is frequent.  A url's
score is the difference of its two log-likelihoods over its length;
the threshold is the one with the fewest balanced errors among the scores of
the urls that rules decide, taken from histograms.

Cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and is judged as the empty or given text; an empty url scores 0;
without urls of one class the threshold lets every url pass; null ids and
repeated rows are returned as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import column, passes, text_of, written

#: Longest context in bytes.
ORDER = 5
#: Symbols of a url: 0 is before its start, b + 1 stands for byte b.
SYMBOLS = 257
#: Most (context, byte) pairs that are broadcast.
FREQUENT = 100_000
#: Weight of a longer context: count / (count + STRENGTH), the rest goes to the shorter one.
STRENGTH = 4.0
#: Scores are counted in bins of this width over [-BOUND, BOUND].
BOUND, BIN = 4.0, 1 / 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER), F.regexp_extract(url, parts, 2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does.
    rules: (verdict, host + path).  Of equally long ones the first wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: len(r[1])):
        own_host, _, own_path = name.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _codes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each byte: the number of it and the ``ORDER`` symbols before it, the byte as last digit.
    A context never reaches before the url; there it is padded with 0."""
    since = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
    symbol = data.astype(np.int64) + 1
    out = symbol.copy()
    for order in range(1, min(ORDER, len(data)) + 1):
        past = np.zeros(len(data), np.int64)
        past[order:] = symbol[:-order]
        past[since < order] = 0
        out += past * SYMBOLS**order
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offs in passes(batches, "url"):
        kind = np.repeat(column(rows, "accepted"), np.diff(offs))
        code, at, n = np.unique(_codes(data, offs), return_inverse=True, return_counts=True)
        by = [np.bincount(at[kind == c], minlength=len(code)) for c in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (code, n, *by)], ["code", "n", "n0", "n1"])


def counted(urls: DataFrame) -> DataFrame:
    """urls: (url, accepted 0/1, or -1 where no rule decides).  code, n (in all
    urls), n0 and n1 (in rejected and accepted ones) of every distinct context of
    ``ORDER`` symbols and byte."""
    parts = urls.select("url", "accepted").mapInArrow(_counted, "code long, n long, n0 long, n1 long")
    return parts.groupBy("code").agg(*[F.sum(x).alias(x) for x in ("n", "n0", "n1")])


def log_ratios(counts: DataFrame) -> DataFrame:
    """code, n, ratio: log-likelihood of the byte after its context as accepted - as rejected."""
    levels = [counts]
    for order in range(ORDER - 1, -1, -1):
        code = F.col("code") % F.lit(SYMBOLS ** (order + 1))
        levels.insert(0, levels[0].groupBy(code.alias("code")).agg(*[F.sum(x).alias(x) for x in ("n", "n0", "n1")]))
    out = None
    for order, level in enumerate(levels):
        # at most SYMBOLS rows share a context, and at most SYMBOLS the code without its first symbol
        context = Window.partitionBy(F.floor(F.col("code") / SYMBOLS))
        level = level.select("*", *[F.sum(x).over(context).alias(f"all_{x}") for x in ("n0", "n1")])
        if order:
            level = level.withColumn("shorter", F.col("code") % F.lit(SYMBOLS**order)).join(out, "shorter")
        else:
            level = level.withColumns({"p0": F.lit(1 / 256), "p1": F.lit(1 / 256)})
        p = [((F.col(f"n{c}") + STRENGTH * F.col(f"p{c}")) / (F.col(f"all_n{c}") + STRENGTH)).alias(f"p{c}") for c in (0, 1)]
        if order == ORDER:
            return level.select("code", "n", *p).select("code", "n", (F.log("p1") - F.log("p0")).alias("ratio"))
        out = level.select(F.col("code").alias("shorter"), *p)


def scored(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """``urls`` with a column score; url must not be null, row is unique.
    ratios: as from ``log_ratios`` of counts that hold every url; written."""
    spark = urls.sparkSession
    total = ratios.agg(F.sum("n")).first()[0] or 0
    common = ratios.where(F.col("n") > total / FREQUENT).select("code", "ratio").orderBy("code").toPandas()  # less than FREQUENT rows
    shared = spark.sparkContext.broadcast((common["code"].to_numpy(np.int64), common["ratio"].to_numpy(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, values = shared.value
        for rows, data, offs in passes(batches, "url"):
            code = _codes(data, offs)
            at = np.searchsorted(codes, code)
            at[at == len(codes)] = 0
            known = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            own = np.zeros(len(code))
            own[known] = values[at[known]]
            upto, rare = np.r_[0.0, np.cumsum(own)], np.r_[0, np.cumsum(~known)]
            part = pa.array(upto[offs[1:]] - upto[offs[:-1]], pa.float64())
            rest = pa.ListArray.from_arrays(pa.array(rare[offs], pa.int32()), pa.array(code[~known], pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, part, rest], [*rows.schema.names, "part", "rare"])

    marked = written(urls.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in urls.dtypes) + ", part double, rare array<long>"))
    rare = marked.select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count("*").alias("times"))
    sums = rare.join(ratios, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("ratio")).alias("more"))
    score = (F.col("part") + F.coalesce("more", F.lit(0.0))) / F.greatest(F.octet_length("url"), F.lit(1))
    return marked.join(sums, "row", "left").select(*urls.columns, F.round(score, 9).alias("score"))


def threshold(rows: DataFrame) -> float:
    """rows: (score, accepted 0/1).  The lower edge from which on urls pass."""
    bins = round(2 * BOUND / BIN)
    place = F.least(F.greatest(F.floor((F.col("score") + BOUND) / BIN), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = np.zeros((2, bins))
    for kind, at, n in rows.groupBy("accepted", place.alias("at")).count().collect():  # at most 2 * bins rows
        counts[kind, at] = n
    total = counts.sum(1)
    if not total.all():
        return -np.inf
    lost = np.r_[0, np.cumsum(counts[1])] / total[1]  # accepted below the edge
    passed = 1 - np.r_[0, np.cumsum(counts[0])] / total[0]  # rejected at or above it
    error = lost + passed
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(best[len(best) // 2] * BIN - BOUND)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score."""
    raw = pages.select(F.col(page_id).cast("long").alias("page_id"), text_of(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    raw = raw.withColumn("host", host).withColumn("path", path)
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = raw.withColumn("rule", rule).withColumn("given", verdict).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows)  # so that row stays the same
    accepted = F.when(F.col("given").isNull(), -1).otherwise((F.col("given") == "allow").cast("int"))
    ratios = written(log_ratios(written(counted(rows.select("url", accepted.alias("accepted"))))))
    marked = written(scored(rows, ratios).drop("url", "row"))
    edge = threshold(marked.where(F.col("given").isNotNull()).select("score", (F.col("given") == "allow").cast("int").alias("accepted")))
    judged = F.when(F.col("score") >= F.lit(edge), "allow").otherwise("block")
    return marked.select("page_id", "host", "path", "rule", F.coalesce("given", judged).alias("verdict"), "score")
