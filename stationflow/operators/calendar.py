"""Calendar aggregates and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = {"hourly": ("year", "month", "hour"), "daily": ("year", "month", "dom", "doy"), "monthly": ("year", "month"), "yearly": ("year",)}


def date_parts() -> dict[str, Column]:
    return {"year": F.year("t"), "month": F.month("t"), "dom": F.dayofmonth("t"), "doy": F.dayofyear("t"), "hour": F.hour("t") + F.minute("t") / 60, "period": (F.floor((F.month("t") % 12) / 3) + 1).cast("int"), "hhmm": F.date_format("t", "HH:mm")}


#: Filled columns without a raw one.
UNPAIRED = ("NEE_U05_f", "NEE_U50_f", "NEE_U95_f", "GPP_U05_f", "GPP_U95_f", "GPP_U50_f", "GPP_f")


def pair_columns(columns: Sequence[str], unpaired: Sequence[str] = UNPAIRED) -> dict[str, str | None]:
    """Filled columns (`_f`) and their raw ones, in the order of the columns; None for those known to have none. Any other without a raw column is an error."""
    filled = [c for c in columns if c.endswith("_f")]
    missing = [c[:-2] for c in filled if c not in unpaired and c[:-2] not in columns]
    if missing:
        raise ValueError(f"filled columns without these raw ones: {', '.join(missing)}")
    return {c: None if c in unpaired else c[:-2] for c in filled}


def calendar_means(df: DataFrame, pairs: Mapping[str, str | None], threshold: float | None = None, aggregates: Mapping[str, Callable[[str], Column]] | None = None) -> DataFrame:
    """level, year, month, dom, doy, hour and for each pair filled -> raw: the mean of filled and the completeness of raw (<filled>_sqc; none without a raw column).

    aggregates: other functions of a column's name in place of the mean, each as <filled>_<its name> (or <filled> where that is empty).
    All four levels are one pass: grouping sets over the date parts. With a threshold, an aggregate is null unless the completeness is over it.
    """
    parts = {k: v for k, v in date_parts().items() if k in ("year", "month", "dom", "doy", "hour")}
    aggs = []
    for filled, raw in pairs.items():
        share = F.count(raw) / F.count("*") if raw is not None else None
        for name, f in (aggregates or {"": F.avg}).items():
            own = f(filled)
            aggs.append((F.when(share > threshold, own) if threshold is not None and share is not None else own).alias(f"{filled}_{name}" if name else filled))
        aggs += [share.alias(f"{filled}_sqc")] if share is not None else []
    keys = list(parts)
    sets = [["site", *LEVELS[level]] for level in LEVELS]
    got = df.withColumns(parts).groupingSets([[F.col(c) for c in s] for s in sets], "site", *keys).agg(F.grouping_id().alias("_g"), *aggs)
    mask = {level: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in LEVELS[level]) for level in LEVELS}
    level = F.coalesce(*(F.when(F.col("_g") == m, F.lit(name)) for name, m in mask.items()))
    return got.withColumn("level", level).drop("_g")


def trim_short_years(df: DataFrame) -> DataFrame:
    """Without a site's first row if the year changes right after it, and its last if it changes right before."""
    order = Window.partitionBy("site").orderBy("t")
    year = F.year("t")
    lone_first = F.lag("t").over(order).isNull() & (F.lead(year).over(order) != year)
    lone_last = F.lead("t").over(order).isNull() & (F.lag(year).over(order) != year)
    return df.withColumn("_x", F.coalesce(lone_first, F.lit(False)) | F.coalesce(lone_last, F.lit(False))).where("not _x").drop("_x")


def attrition(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """site, var, filter, entering, rejected, percent (of all rows): what each filter of the cumulative chain takes."""
    before = [F.lit(1), *map(F.col, flags[:-1])]
    aggs = [F.count("*").alias("n")]
    for i, (f, b) in enumerate(zip(flags, before)):
        aggs += [F.sum((b == 1).cast("int")).alias(f"e{i}"), F.sum(((b == 1) & (F.col(f) == 0)).cast("int")).alias(f"r{i}")]
    got = df.groupBy("site", "var").agg(*aggs)
    rows = F.explode(F.array(*(F.struct(F.lit(f).alias("filter"), F.col(f"e{i}").alias("entering"), F.col(f"r{i}").alias("rejected")) for i, f in enumerate(flags))))
    return got.select("site", "var", "n", rows.alias("x")).select("site", "var", "x.*", F.round(100.0 * F.col("x.rejected") / F.col("n"), 8).alias("percent"))


def rejected_by_first(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """site, var, first, n: rows by the filter that was first to reject them; `good` for none."""
    first = F.coalesce(*(F.when(F.col(f) == 0, F.lit(f)) for f in flags), F.lit("good"))
    return df.groupBy("site", "var", first.alias("first")).agg(F.count("*").alias("n"))


def describe(df: DataFrame, value: str = "value") -> DataFrame:
    q = F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    got = df.groupBy("site", "var").agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("lo"), F.max(value).alias("hi"), q.alias("q"))
    return got.select("site", "var", "n", "mean", "std", "lo", F.get("q", F.lit(0)).alias("q25"), F.get("q", F.lit(1)).alias("q50"), F.get("q", F.lit(2)).alias("q75"), "hi")


def compare_stats(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Mean and deviation of each variable against a reference station's (var, ref_mean, ref_std), and whether it is far off by either bound."""
    own = df.groupBy("site", "var").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    gap = F.abs(F.col("mean") - F.col("ref_mean"))
    return own.join(F.broadcast(reference), "var").withColumns({"off": gap > 2 * F.col("ref_std"), "far_off": gap > 2 * F.greatest("std", "ref_std")})


def fingerprint(df: DataFrame, slots: int = 48) -> DataFrame:
    """One row a day, one column a slot."""
    return df.withColumn("date", F.date_format("t", "yyyy-MM-dd")).groupBy("site", "var", "date").pivot("slot", list(range(slots))).agg(F.avg("value"))


def diurnal_cycle(df: DataFrame) -> DataFrame:
    return df.groupBy("site", "var", F.month("t").alias("month"), "slot").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count("value").alias("n"))


#: Unit of the daily aggregate, and whether it is a sum or a mean, by variable.
DAILY_UNITS = {"nee": ("gC m-2 d-1", "sum"), "reco": ("gC m-2 d-1", "sum"), "gpp": ("gC m-2 d-1", "sum"), "co2_flux": ("gC m-2 d-1", "sum"), "le": ("W m-2", "mean"), "h": ("W m-2", "mean"), "ta": ("degC", "mean"), "rg": ("W m-2", "mean"), "vpd": ("kPa", "mean"), "p_rain": ("mm", "sum")}
#: umol of CO2 a second, over half an hour, in grams of carbon.
CARBON = 1800 * 12.011 / 1_000_000


def daily_sums(df: DataFrame, per_day: int = 48) -> DataFrame:
    """site, var, date, total (by the variable's rule; sums are the mean times the steps of a day), sd (of the total), unit."""
    table = df.sparkSession.createDataFrame([(k, *v) for k, v in DAILY_UNITS.items()], "var string, unit string, how string")
    got = df.groupBy("site", "var", F.date_format("t", "yyyy-MM-dd").alias("date")).agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"), F.count("value").alias("n"))
    got = got.join(F.broadcast(table), "var")
    scale = F.when(F.col("unit").startswith("gC"), CARBON).otherwise(1.0) * F.when(F.col("how") == "sum", per_day).otherwise(1)
    return got.select("site", "var", "date", (F.col("m") * scale).alias("total"), (F.col("s") / F.sqrt("n") * scale).alias("sd"), "unit", "how")


def site_year(df: DataFrame) -> DataFrame:
    return df.groupBy("site").agg(F.percentile(F.year("t"), F.lit(0.5)).cast("int").alias("year"))


def limits(df: DataFrame, value: str = "value") -> DataFrame:
    """The 0 and 0.99 quantiles."""
    q = F.percentile(value, F.array(F.lit(0.0), F.lit(0.99)))
    return df.groupBy("site", "var").agg(q.alias("q")).select("site", "var", F.get("q", F.lit(0)).alias("lo"), F.get("q", F.lit(1)).alias("hi"))


def restore_units(columns: DataFrame, units: DataFrame) -> DataFrame:
    """column, unit: each result column's unit from the sidecar; -- for those without."""
    return columns.join(units, "column", "left").select("column", F.coalesce("unit", F.lit("--")).alias("unit"))
