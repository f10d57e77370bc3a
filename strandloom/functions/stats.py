"""Descriptive statistics with the definitions of the usual small-sample library, as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _n(x: Column) -> Column:
    return F.count(x)


def variance(x: Column, population: bool = False) -> Column:
    """Sample variance, 0 for fewer than two values."""
    return F.coalesce(F.greatest(F.var_pop(x) if population else F.var_samp(x), F.lit(0.0)), F.lit(0.0))


def deviation(x: Column, population: bool = False) -> Column:
    return F.sqrt(variance(x, population))


def skewness(x: Column) -> Column:
    """Bias-corrected; null for fewer than three values or no spread."""
    n = _n(x).cast("double")
    return F.when((n > 2) & (F.var_samp(x) > 0), F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis(x: Column) -> Column:
    """Bias-corrected excess; null for fewer than four values or no spread."""
    n = _n(x).cast("double")
    return F.when((n > 3) & (F.var_samp(x) > 0), ((n + 1) * F.kurtosis(x) + 6) * (n - 1) / ((n - 2) * (n - 3)))


def harmonic_mean(x: Column) -> Column:
    """Null if any value is zero."""
    return F.when(F.sum((x == 0).cast("int")) == 0, _n(x) / F.sum(1 / F.nullif(x.cast("double"), F.lit(0.0))))


def geometric_mean(x: Column) -> Column:
    """Null if any value is negative, 0 if any is zero."""
    return F.when(F.min(x) > 0, F.exp(F.avg(F.ln(F.when(x > 0, x))))).when(F.min(x) == 0, 0.0)


def span(x: Column) -> Column:
    return F.max(x) - F.min(x)


def describe(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """count, sum, sumsq, mean, min, max, range, variance, sd, skewness, kurtosis, harmonic and geometric mean, to six digits."""
    x = F.col(column).cast("double")
    made = {
        "n": _n(x), "total": F.sum(x), "sumsq": F.sum(x * x), "mean": F.avg(x), "least": F.min(x), "most": F.max(x), "span": span(x), "variance": variance(x), "sd": deviation(x),
        "skewness": skewness(x), "kurtosis": kurtosis(x), "harmonic": harmonic_mean(x), "geometric": geometric_mean(x),
    }
    return df.groupBy(*by).agg(*[(v if k == "n" else F.round(v, 6)).alias(k) for k, v in made.items()])


def extreme_index(df: DataFrame, by: list[str], column: str, order: str) -> DataFrame:
    """mindex, maxdex: the last place (of `order`) with the least and the largest value."""
    return df.groupBy(*by).agg(F.max_by(order, F.struct(-F.col(column), F.col(order))).alias("mindex"), F.max_by(order, F.struct(F.col(column), F.col(order))).alias("maxdex"))


def counted(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """by, x, c, upto, n: different values with how often, how many up to each, and in all; what quantiles need."""
    c = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("x")).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*by)
    return c.withColumns({"upto": F.sum("c").over(w.orderBy("x")), "n": F.sum("c").over(w)})


def percentile(df: DataFrame, by: list[str], column: str, p: float) -> DataFrame:
    """The value at place ceil(n p / 100); null if p is below 100 / n."""
    place = F.ceil(F.col("n") * p / 100)
    return counted(df, by, column).groupBy(*by).agg(F.min(F.when((F.col("upto") >= place) & (F.lit(p) >= 100 / F.col("n")), F.col("x"))).alias("percentile"))


def quantiles(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """q0 to q4 by linear interpolation, and the median."""
    x = F.col(column).cast("double")
    return df.groupBy(*by).agg(*[F.round(F.percentile(x, k / 4), 6).alias(f"q{k}") for k in range(5)], F.round(F.median(x), 6).alias("median"))


def trimmed_mean(df: DataFrame, by: list[str], column: str, low: float, high: float | None = None) -> DataFrame:
    """Mean without the floor(n * low) least and floor(n * high) largest values."""
    high = low if high is None else high
    c = counted(df, by, column)
    lo, hi = F.floor(F.col("n") * low), F.col("n") - F.floor(F.col("n") * high)
    kept = F.greatest(F.least(F.col("upto"), hi) - F.greatest(F.col("upto") - F.col("c"), lo), F.lit(0))
    return c.groupBy(*by).agg(F.round(F.sum(F.col("x") * kept) / F.nullif(F.sum(kept), F.lit(0)), 6).alias("trimmed"))


def mode(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """The most frequent value (ties: the least); null if all are different."""
    c = counted(df, by, column)
    return c.groupBy(*by).agg(F.min_by("x", F.struct(-F.col("c"), F.col("x"))).alias("x"), F.max("c").alias("top")).select(*by, F.when(F.col("top") > 1, F.col("x")).alias("mode"))


def frequencies(df: DataFrame, column: str, bins: int) -> DataFrame:
    """upper, n: values up to each of `bins` equal steps between the least and the largest, empty ones too."""
    x = F.col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    k = F.when(F.col("hi") == F.col("lo"), 1).otherwise(F.greatest(F.ceil((x - F.col("lo")) / F.nullif(step, F.lit(0.0))), F.lit(1))).cast("int")
    counts = df.where(x.isNotNull()).crossJoin(F.broadcast(ends)).select(F.least(k, F.lit(bins)).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    every = ends.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), F.col("lo"), step.alias("step"))
    return every.join(counts, "bin", "left").select("bin", F.round(F.col("lo") + F.col("bin") * F.col("step"), 6).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))


def least_squares(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """intercept, slope, r, rms of the fit of y on x."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    n = F.regr_count(cy, cx)
    error = F.regr_syy(cy, cx) - F.pow(F.regr_sxy(cy, cx), F.lit(2)) / F.nullif(F.regr_sxx(cy, cx), F.lit(0.0))
    return df.groupBy(*by).agg(F.round(F.regr_intercept(cy, cx), 6).alias("intercept"), F.round(F.regr_slope(cy, cx), 6).alias("slope"), F.round(F.corr(cy, cx), 6).alias("r"), F.round(F.sqrt(F.greatest(error, F.lit(0.0)) / n), 5).alias("rms"))


def median_deviation(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """mad: median distance from the median."""
    m = df.groupBy(*by).agg(F.median(F.col(column).cast("double")).alias("_m"))
    return df.join(m, by).groupBy(*by).agg(F.round(F.median(F.abs(F.col(column) - F.col("_m"))), 6).alias("mad"))


def add_histograms(*tables: DataFrame) -> DataFrame:
    """Histograms (keys ..., n) added up."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy(*[c for c in out.columns if c != "n"]).agg(F.sum("n").alias("n"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b).union(b.exceptAll(a)).distinct()


def scale_linear(x: Column, low: Column, high: Column, to_low: float, to_high: float) -> Column:
    """x between low and high mapped to to_low .. to_high; the middle if there is no span."""
    return F.when(high == low, (to_low + to_high) / 2).otherwise(to_low + (x - low) * (to_high - to_low) / F.nullif(high - low, F.lit(0.0)))
