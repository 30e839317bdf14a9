"""Quality filters over observations in long form: one row for each (site, t, var), with value and qc.

Every filter adds one flag column (1 keeps, 0 rejects). A flag starts as the flag before it and only ever turns to 0, so flags are
cumulative and their order matters. A comparison with a missing value rejects nothing. Values stay as they are until apply_flags().

Limits come as small rule tables, one row for each variable, joined by broadcast: their size is the number of variables. What has rows for each
site (ranges, quantiles) is joined without a hint: its size decides. Drivers (radiation, rain,
signal strength) come joined to the observations by (site, t). Stamps must be on the regular grid for filters with row frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("site", "t", "var")
#: The variables that each meteorological filter applies to.
CO2_VARS = ("co2_flux", "nee")
RH_VARS = ("co2_flux", "le", "nee")
RAIN_VARS = ("co2_flux", "h", "le", "nee", "ch4_flux")


def flag(df: DataFrame, name: str, reject: Column, before: str | None = None) -> DataFrame:
    """df with the flag `name`: that of `before` (or 1), and 0 where `reject` holds."""
    start = F.col(before) if before else F.lit(1)
    return df.withColumn(name, F.when(F.coalesce(reject, F.lit(False)), 0).otherwise(start).cast("int"))


def rules(df: DataFrame, table: Mapping[str, Sequence], names: Sequence[str]) -> DataFrame:
    """df with each variable's parameters as columns; null where it has none."""
    kinds = ["double" if any(isinstance(v[i], float) for v in table.values()) else "boolean" if any(isinstance(v[i], bool) for v in table.values()) else "int" for i in range(len(names))]
    rows = df.sparkSession.createDataFrame([(k, *v) for k, v in table.items()], ", ".join(["var string", *(f"{n} {k}" for n, k in zip(names, kinds))]))
    return df.join(F.broadcast(rows), "var", "left")


def qc_filter(df: DataFrame, limits: Mapping[str, int], name: str = "f_qc", before: str | None = None) -> DataFrame:
    """Rejects where the quality code exceeds the variable's limit; nee goes by the code and the limit of co2_flux (its rows carry that code)."""
    table = {v: (limits["co2_flux"] if v == "nee" else n,) for v, n in limits.items()}
    return flag(rules(df, table, ["_limit"]), name, F.col("qc") > F.col("_limit"), before).drop("_limit")


def below(df: DataFrame, driver: str, least: float, variables: Sequence[str], name: str, before: str | None = None) -> DataFrame:
    """Rejects where a driver (a signal strength) is under its least value."""
    return flag(df, name, F.col("var").isin(*variables) & (F.col(driver) < least), before)


def above(df: DataFrame, driver: str, most: float, variables: Sequence[str], name: str, before: str | None = None) -> DataFrame:
    """Rejects where a driver (relative humidity) is over its greatest value."""
    return flag(df, name, F.col("var").isin(*variables) & (F.col(driver) > most), before)


def rain_filter(df: DataFrame, limit: float, forward: int, variables: Sequence[str] = RAIN_VARS, name: str = "f_rain", before: str | None = None) -> DataFrame:
    """Rejects where it rains more than the limit at this step or at one of the forward - 1 steps before. On the grid: the frame counts rows."""
    near = Window.partitionBy("site", "var").orderBy("t").rowsBetween(-(forward - 1), 0)
    wet = F.max((F.col("p_rain") > limit).cast("int")).over(near) == 1
    return flag(df, name, F.col("var").isin(*variables) & wet, before)


def night_filter(df: DataFrame, nee_min: float, h_limits: tuple[float, float], le_limits: tuple[float, float], compat: bool = False, dark: float = 10.0, name: str = "f_night", before: str | None = None) -> DataFrame:
    """At night (radiation under `dark`): nee under its least value, co2_flux under 0, h and le outside their limits.

    compat: as in the original, le is judged by the value of h at the same stamp (column h_value).
    """
    value = F.col("value")
    outside = lambda x, lim: (x < lim[0]) | (x > lim[1])
    le = F.col("h_value") if compat else value
    bad = (
        F.when(F.col("var") == "nee", value < nee_min).when(F.col("var") == "co2_flux", value < 0)
        .when(F.col("var") == "h", outside(value, h_limits)).when(F.col("var") == "le", outside(le, le_limits))
    )
    return flag(df, name, (F.col("swin") < dark) & bad, before)


def day_filter(df: DataFrame, swin_limit: float, nee_max: float, name: str = "f_day", before: str | None = None) -> DataFrame:
    return flag(df, name, (F.col("var") == "nee") & (F.col("swin") >= swin_limit) & (F.col("value") > nee_max), before)


def in_ranges(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """df with _in: is t in one of its site's date ranges (ends included)? Ranges are gathered to one array a site, so overlaps add no row."""
    by_site = ranges.groupBy("site").agg(F.collect_list(F.struct("start", "stop")).alias("_r"))
    held = F.exists("_r", lambda r: F.col("t").between(r["start"], r["stop"]))
    return df.join(by_site, "site", "left").withColumn("_in", F.coalesce(held, F.lit(False))).drop("_r")


def winter_filter(df: DataFrame, ranges: DataFrame, limits: Mapping[str, tuple[float, float]], name: str = "f_winter", before: str | None = None) -> DataFrame:
    """Within the site's winter ranges, rejects values outside the variable's winter limits."""
    own = rules(in_ranges(df, ranges), limits, ["_lo", "_hi"])
    return flag(own, name, F.col("_in") & ((F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi"))), before).drop("_in", "_lo", "_hi")


def manual_filter(df: DataFrame, ranges: DataFrame, value: int = 0, variables: Sequence[str] = ("nee",), name: str = "f_manual", before: str | None = None) -> DataFrame:
    """Within the ranges, the flag becomes `value`; elsewhere it is the one before."""
    start = F.col(before) if before else F.lit(1)
    own = in_ranges(df, ranges)
    return own.withColumn(name, F.when(F.col("_in") & F.col("var").isin(*variables), value).otherwise(start).cast("int")).drop("_in")


def min_max_filter(df: DataFrame, limits: Mapping[str, tuple[float, float]], name: str = "f_minmax", before: str | None = None) -> DataFrame:
    """Rejects values outside the limits. rh is first clipped from above; swin and ppfd from below, and swin is then tested from above only."""
    table = {v: (lo, hi, v == "rh", v in ("swin", "ppfd")) for v, (lo, hi) in limits.items()}
    own = rules(df, table, ["_lo", "_hi", "_top", "_bottom"])
    clipped = F.when(F.col("_top"), F.least("value", "_hi")).when(F.col("_bottom"), F.greatest("value", "_lo")).otherwise(F.col("value"))
    own = own.withColumn("value", F.when(F.col("value").isNotNull(), clipped))
    return flag(own, name, (F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi")), before).drop("_lo", "_hi", "_top", "_bottom")


def survivors(before: str | None) -> Column:
    return F.when(F.col(before) == 1, F.col("value")) if before else F.col("value")


def quantile_filter(df: DataFrame, quantiles: Mapping[str, tuple[float, float]], name: str = "f_quantile", before: str | None = None) -> DataFrame:
    """Rejects values under the lower or over the upper quantile (linear) of what survives, by site and variable.

    The quantiles are one aggregated row for each (site, var), joined back: no window over a whole series.
    """
    lows, highs = sorted({q[0] for q in quantiles.values()}), sorted({q[1] for q in quantiles.values()})
    wanted = df.where(F.col("var").isin(*quantiles))
    got = wanted.groupBy("site", "var").agg(F.percentile(survivors(before), F.array(*map(F.lit, lows))).alias("_l"), F.percentile(survivors(before), F.array(*map(F.lit, highs))).alias("_h"))
    place = {v: (lows.index(lo), highs.index(hi)) for v, (lo, hi) in quantiles.items()}
    got = rules(got, place, ["_i", "_j"]).select("site", "var", F.get("_l", F.col("_i")).alias("_lo"), F.get("_h", F.col("_j")).alias("_hi"))
    return flag(df.join(got, ["site", "var"], "left"), name, (F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi")), before).drop("_lo", "_hi")


def diurnal_mean(value: Column, days: int, least: int, by: Sequence[str] = ("site", "var")) -> Column:
    """The mean of a slot of the day over `days` days centred on each row (more before than after if even); null with under `least` values."""
    near = Window.partitionBy(*by, "slot").orderBy("t").rowsBetween(-(days // 2), (days - 1) // 2)
    return F.when(F.count(value).over(near) >= least, F.avg(value).over(near))


def std_window_filter(df: DataFrame, config: Mapping[str, tuple[float, int, int]], per_day: int = 48, name: str = "f_std", before: str | None = None) -> DataFrame:
    """Rejects values further from the rolling diurnal mean of what survives than sigmas times the rolling deviation of the residuals.

    config: variable -> (sigmas, days, least days). Frames differ by days, so variables go by their days; null bounds reject nothing. On the grid.
    """
    out = None
    for days, least in sorted({v[1:] for v in config.values()}):
        own = {v: (float(c[0]),) for v, c in config.items() if c[1:] == (days, least)}
        part = df.where(F.col("var").isin(*own)).withColumn("_mean", diurnal_mean(survivors(before), days, least))
        n = days * per_day
        near = Window.partitionBy("site", "var").orderBy("t").rowsBetween(-(n // 2) - 1, n // 2 - 1)
        part = part.withColumn("_res", survivors(before) - F.col("_mean"))
        part = part.withColumn("_sigma", F.when(F.count("_res").over(near) >= n // 2, F.stddev_samp("_res").over(near)))
        part = rules(part, own, ["_k"])
        part = flag(part, name, F.abs(F.col("value") - F.col("_mean")) > F.col("_k") * F.col("_sigma"), before).drop("_mean", "_res", "_sigma", "_k")
        out = part if out is None else out.unionByName(part)
    rest = flag(df.where(~F.col("var").isin(*config)), name, F.lit(False), before)
    return rest if out is None else out.unionByName(rest)


def mad_hampel_filter(df: DataFrame, config: Mapping[str, tuple[float, int]], name: str = "f_hampel", before: str | None = None) -> DataFrame:
    """Spikes among the surviving rows, whose neighbours are the surviving rows next to them.

    A value is rejected if its second difference is over z robust deviations (median absolute deviation / 0.6745) from the median second
    difference of its site and variable, or if it is over z robust deviations from the median of `window` rows around it.
    config: variable -> (z, window).
    """
    out = None
    live = df.where((F.col(before) == 1 if before else F.lit(True)) & F.col("value").isNotNull())
    for window in sorted({w for _, w in config.values()}):
        own = {v: (float(z),) for v, (z, w) in config.items() if w == window}
        order = Window.partitionBy("site", "var").orderBy("t")
        near = order.rowsBetween(-(window // 2), window // 2)
        second = (F.col("value") - F.lag("value").over(order)) - (F.lead("value").over(order) - F.col("value"))
        part = live.where(F.col("var").isin(*own)).select(*KEY, "value", second.alias("_d"))
        part = part.withColumn("_m", F.percentile("value", F.lit(0.5)).over(near))
        part = part.withColumn("_a", F.percentile(F.abs(F.col("value") - F.col("_m")), F.lit(0.5)).over(near))
        centre = part.groupBy("site", "var").agg(F.percentile("_d", F.lit(0.5)).alias("_dm"))
        part = part.join(centre, ["site", "var"])
        spread = part.groupBy("site", "var").agg(F.percentile(F.abs(F.col("_d") - F.col("_dm")), F.lit(0.5)).alias("_da"))
        part = rules(part.join(spread, ["site", "var"]), own, ["_z"])
        scaled = lambda x, a: F.abs(x) > F.col("_z") * F.col(a) / 0.6745
        bad = scaled(F.col("_d") - F.col("_dm"), "_da") | scaled(F.col("value") - F.col("_m"), "_a")
        part = part.where(F.coalesce(bad, F.lit(False))).select(*KEY, F.lit(True).alias("_bad"))
        out = part if out is None else out.unionByName(part)
    return flag(df, name, F.lit(False), before) if out is None else flag(df.join(out, list(KEY), "left"), name, F.col("_bad"), before).drop("_bad")


def custom_filter(df: DataFrame, reject: Column, name: str, before: str | None = None) -> DataFrame:
    """A caller's own rule, in the same chain."""
    return flag(df, name, reject, before)


def meteorological_filter(df: DataFrame, co2ss: float, rain: float, forward: int, rh: float, name: str = "f_phys") -> DataFrame:
    """Signal, rain and humidity in one flag."""
    own = below(df, "co2_signal_strength", co2ss, ("co2_flux",), "_a")
    own = rain_filter(own, rain, forward, ("co2_flux", "h", "le", "ch4_flux"), "_b", "_a")
    return above(own, "rh", rh, ("co2_flux", "le"), name, "_b").drop("_a", "_b")


def collapse_flags(df: DataFrame, flags: Sequence[str], name: str = "ok") -> DataFrame:
    """All flags as one; 1 where there is none."""
    return df.withColumn(name, (F.least(*flags) if len(flags) > 1 else F.col(flags[0]) if flags else F.lit(1)).cast("int"))


def apply_flags(df: DataFrame, ok: str = "ok", name: str = "filtered") -> DataFrame:
    return df.withColumn(name, F.when(F.col(ok) == 1, F.col("value")))


def undo_last(df: DataFrame, flags: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without the last flag: flags are never overwritten, so the one before is still there."""
    return df.drop(flags[-1]), list(flags[:-1])
