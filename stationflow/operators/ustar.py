"""Low-turbulence periods: friction-velocity thresholds by season, their bootstrap, and the filter."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .gapfill import fill_series, nee_uncertainty


def nights(df: DataFrame, dark: float = 10.0) -> DataFrame:
    """The rows that thresholds are estimated from."""
    return df.where((F.col("swin") < dark) & F.col("nee").isNotNull() & F.col("ta").isNotNull() & F.col("u_star").isNotNull())


def tiles(df: DataFrame, name: str, k: int, by: list[str], order: list[str], weight: str | None = None) -> DataFrame:
    """df with the ntile of each row. With a weight, a row stands for that many equal rows side by side: tiles come from running sums, and a row on an edge is split between its tiles."""
    if weight is None:
        return df.withColumn(name, F.ntile(k).over(Window.partitionBy(*by).orderBy(*order)))
    whole = Window.partitionBy(*by)
    own = df.withColumns({"_n": F.sum(weight).over(whole), "_to": F.sum(weight).over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))})
    own = own.withColumns({"_q": F.floor(F.col("_n") / k).cast("long"), "_r": F.col("_n") % k, "_from": F.col("_to") - F.col(weight) + 1})
    long = F.col("_r") * (F.col("_q") + 1)  # rows in the tiles that hold one more
    of = lambda at: F.when(at <= long, F.floor((at - 1) / (F.col("_q") + 1)) + 1).otherwise(F.col("_r") + F.floor((at - 1 - long) / F.greatest(F.col("_q"), F.lit(1))) + 1).cast("int")
    own = own.withColumn(name, F.explode(F.sequence(of(F.col("_from")), of(F.col("_to")))))
    end = lambda i: i * F.col("_q") + F.least(i, F.col("_r"))
    part = F.least("_to", end(F.col(name))) - F.greatest(F.col("_from"), end(F.col(name) - 1) + 1) + 1
    return own.withColumn(weight, part).drop("_n", "_to", "_q", "_r", "_from")


def threshold(df: DataFrame, classes: int = 7, bins: int = 20, plateau: float = 0.95, ahead: int = 10, by: tuple[str, ...] = ("site", "season"), dark: float = 10.0, most_cor: float | None = None, least_class: int = 0, weight: str | None = None) -> DataFrame:
    """`by`, ustar: per temperature class of the night rows, the mean u* of the first bin whose mean NEE reaches the plateau of the next bins; the median over classes.

    df: nee, ta, u_star, swin, t. Ties in the classes are broken by t. Classes and bins are ntiles, so all steps are windows and aggregates. A class in which temperature
    and u* correlate by more than most_cor (its fluxes then follow the temperature), or with under least_class rows, gives none. weight: how many rows each stands for.
    """
    own = tiles(nights(df, dark), "tc", classes, [*by], ["ta", "t"], weight)
    if most_cor is not None or least_class:
        stats = own.groupBy(*by, "tc").agg(F.count("*").alias("_n"), F.corr("ta", "u_star").alias("_c"))
        kept = (F.col("_n") >= least_class) & (F.lit(most_cor is None) | F.isnan("_c") | F.col("_c").isNull() | (F.abs("_c") <= F.lit(most_cor)))
        own = own.join(stats.where(kept).select(*by, "tc"), [*by, "tc"])
    own = tiles(own, "ub", bins, [*by, "tc"], ["u_star", "t"], weight)
    mean = lambda c: F.avg(c) if weight is None else F.sum(F.col(c) * F.col(weight)) / F.sum(weight)
    means = own.groupBy(*by, "tc", "ub").agg(mean("nee").alias("m"), mean("u_star").alias("u"))
    frame = Window.partitionBy(*by, "tc").orderBy("ub").rowsBetween(1, ahead)
    reached = means.withColumn("later", F.avg("m").over(frame)).where(F.col("m") > plateau * F.col("later"))
    return reached.groupBy(*by, "tc").agg(F.min_by("u", "ub").alias("u")).groupBy(*by).agg(F.percentile("u", F.lit(0.5)).alias("ustar"))


def pooled_thresholds(df: DataFrame, least_season: int = 160, least_class: int = 100, most_cor: float = 0.5, dark: float = 10.0, **more) -> DataFrame:
    """site, season, n (night rows), pooled, ustar for every season of the data.

    Seasons with under least_season night rows take the threshold of all of the site's night rows together. Classes are judged by correlation and size; ustar is null where no class is left.
    """
    own = nights(df, dark).withColumn("_n", F.count("*").over(Window.partitionBy("site", "season")))
    thin = F.col("_n") < least_season
    own = own.withColumn("_any", F.max(thin).over(Window.partitionBy("site")))
    rows = own.withColumn("_of", F.explode(F.array_compact(F.array(F.when(~thin, F.struct(F.lit(False).alias("pooled"), F.col("season").alias("name"))), F.when(F.col("_any"), F.struct(F.lit(True).alias("pooled"), F.lit("").alias("name")))))))
    got = threshold(rows.withColumns({"pooled": F.col("_of.pooled"), "name": F.col("_of.name")}), by=("site", "pooled", "name"), dark=dark, most_cor=most_cor, least_class=least_class, **more)
    counts = nights(df, dark).groupBy("site", "season").agg(F.count("*").alias("n"))
    seasons = df.select("site", "season").distinct().join(counts, ["site", "season"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    seasons = seasons.withColumn("pooled", F.col("n") < least_season).withColumn("name", F.when(F.col("pooled"), "").otherwise(F.col("season")))
    return seasons.join(got, ["site", "pooled", "name"], "left").select("site", "season", "n", "pooled", "ustar")


def yearly(seasons: DataFrame) -> DataFrame:
    """The highest season's threshold for each site."""
    return seasons.groupBy("site").agg(F.max("ustar").alias("ustar"))


#: Cumulative probabilities of a Poisson draw with mean 1.
POISSON = tuple(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(6))


def bootstrap(df: DataFrame, replicates: int = 200, quantiles: tuple[float, ...] = (0.05, 0.5, 0.95), seed: int = 1) -> DataFrame:
    """site, U05, U50, U95 ...: quantiles of the yearly thresholds of resampled series.

    A replicate takes each row as often as a Poisson draw says, which comes from eight hex digits of the MD5 of `site|t|seed|block` (a digest serves four
    replicates), so it is the same on every run and any split of the data. The number of times is a weight: rows aren't copied. The replicate is a column: all run as one job.
    """
    digest = F.md5(F.concat_ws("|", "site", F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit(str(seed)), F.col("block").cast("string")))
    own = nights(df).select("site", "season", "t", "nee", "ta", "u_star", "swin").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // 4)))).withColumn("digest", digest)
    own = own.select("*", F.posexplode(F.array(*(F.substring("digest", 1 + 8 * i, 8) for i in range(4)))).alias("i", "hex")).withColumn("rep", 4 * F.col("block") + F.col("i") + 1).where(F.col("rep") <= replicates)
    u = (F.conv("hex", 16, 10).cast("long") + 0.5) / 4294967296.0
    rows = own.withColumn("n", sum(((u > p).cast("long") for p in POISSON), F.lit(0).cast("long"))).where("n > 0").drop("block", "digest", "i", "hex")
    each = threshold(rows, by=("site", "season", "rep"), weight="n").groupBy("site", "rep").agg(F.max("ustar").alias("ustar"))
    return each.groupBy("site").agg(*(F.percentile("ustar", F.lit(q)).alias(f"U{round(q * 100):02d}") for q in quantiles))


def ustar_filter(df: DataFrame, thresholds: DataFrame, by: tuple[str, ...] = ("site",), value: str = "nee", night_only: bool = True, dark: float = 10.0) -> DataFrame:
    """df with the value null where u* is under the threshold, at night or (without a radiation source) always."""
    low = F.col("u_star") < F.col("ustar")
    bad = low & (F.col("swin") < dark) if night_only else low
    return df.join(thresholds, list(by), "left").withColumn(f"{value}_ustar", F.when(~F.coalesce(bad, F.lit(False)), F.col(value)))


def fallback(thresholds: DataFrame, seasons: DataFrame, value: float = 0.01, has_radiation: bool = True) -> DataFrame:
    """A threshold for every season of the list: the estimate, else the fallback; without radiation, the fallback for all."""
    got = seasons.join(thresholds, [c for c in seasons.columns if c in thresholds.columns], "left")
    return got.withColumn("ustar", F.coalesce(F.col("ustar") if has_radiation else F.lit(None).cast("double"), F.lit(value)))


def scenarios(df: DataFrame, quantiles: DataFrame, names: tuple[str, ...] = ("U05", "U50", "U95")) -> DataFrame:
    """One filtered series a scenario, as rows: `scenario` is a column of the key."""
    long = quantiles.select("site", F.explode(F.array(*(F.struct(F.lit(n).alias("scenario"), F.col(n).alias("ustar")) for n in names))).alias("s")).select("site", "s.*")
    return ustar_filter(df, long)


def filled_scenarios(df: DataFrame, quantiles: DataFrame, names: tuple[str, ...] = ("U05", "U50", "U95"), others: tuple[str, ...] = ("h", "le"), uncertain: tuple[str, ...] = ("nee", "h", "le")) -> DataFrame:
    """One filled series for each threshold scenario of nee, and one (scenario '') for each other variable: site, var, scenario, t, value, filled, fsd, fnum, stage, fqc.

    df: site, t, nee, the others, swin, vpd, ta, u_star. Deviations of measured rows only for the `uncertain` variables.
    """
    nee = scenarios(df, quantiles, names).select("site", F.lit("nee").alias("var"), "scenario", "t", F.col("nee_ustar").alias("value"))
    rest = df.select("site", "t", F.explode(F.array(*(F.struct(F.lit(v).alias("var"), F.col(v).alias("value")) for v in others))).alias("s")).select("site", "s.var", F.lit("").alias("scenario"), "t", "s.value")
    return fill_series(nee.unionByName(rest), df.select("site", "t", F.col("swin").alias("rg"), "vpd", "ta"), uncertain=F.col("var").isin(*uncertain))


def scenario_spread(filled: DataFrame, base: str = "U50") -> DataFrame:
    """site, t, fsdu, fsdug: the deviation over the scenarios' filled nee (their range is 95 %), and that with the base scenario's own."""
    own = filled.where("var = 'nee'").groupBy("site", "t").agg(F.min("filled").alias("low"), F.max("filled").alias("high"), F.max(F.when(F.col("scenario") == base, F.col("fsd"))).alias("fsd"))
    spread, both = nee_uncertainty(F.col("low"), F.col("high"), F.col("fsd"))
    return own.select("site", "t", spread.alias("fsdu"), both.alias("fsdug"))


def verify_theoretical_rg(df: DataFrame, real: str, theory: str, dark: float = 10.0) -> DataFrame:
    """How well measured and theoretical radiation agree: share of steps with the same night, share missing, mean and median difference."""
    gap = F.abs(F.col(real) - F.col(theory))
    return df.groupBy("site").agg(
        F.avg(((F.col(real) < dark) == (F.col(theory) < dark)).cast("double")).alias("same_night"), F.avg(F.col(real).isNull().cast("double")).alias("missing"), F.avg(gap).alias("mean_gap"), F.percentile(gap, F.lit(0.5)).alias("median_gap")
    )
