"""Regular time grids, merges and calendars. Frames of other operators count rows, so they need what repair_time() gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def infer_step(df: DataFrame, look: int = 100, block: int = 5) -> DataFrame:
    """site, step (seconds): the first block of `block` equal deltas among the first rows, the first delta left out; null if there is none."""
    order = Window.partitionBy("site").orderBy("t")
    own = df.select("site", "t", F.row_number().over(order).alias("rn"), (F.unix_seconds(F.col("t").cast("timestamp")) - F.unix_seconds(F.lag("t").over(order).cast("timestamp"))).alias("d")).where(F.col("rn") <= look)
    own = own.where("rn >= 3").withColumn("b", F.floor((F.col("rn") - 3) / block).cast("int"))
    blocks = own.groupBy("site", "b").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    return blocks.groupBy("site").agg(F.min_by("lo", F.when((F.col("n") == block) & (F.col("lo") == F.col("hi")), F.col("b"))).alias("step"))


def keep_first(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order (file order, not an arbitrary one)."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")


def grid(spans: DataFrame, step: str, by: list[str]) -> DataFrame:
    """One row for each step from lo to hi."""
    return spans.select(*by, F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("t"))


def repair_time(df: DataFrame, step: str = "30 MINUTES", by: tuple[str, ...] = ("site",), order: tuple[str, ...] = (), fill_gaps: bool = True) -> DataFrame:
    """Stamps made unique (first in order) and regular from each key's first to last; missing steps become rows of nulls.

    The grid starts at the first stamp and stamps off it are dropped: strict_repair() judges the series first.
    """
    own = keep_first(df.where(F.col("t").isNotNull()), [*by, "t"], [F.col(c) for c in order] or [F.col("t")])
    spans = own.groupBy(*by).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    return grid(spans, step, list(by)).join(own, [*by, "t"], "left" if fill_gaps else "inner")


def off_grid(df: DataFrame, seconds: int = 1800, by: tuple[str, ...] = ("site",)) -> DataFrame:
    spans = df.groupBy(*by).agg(F.min("t").alias("lo"))
    gap = F.unix_seconds(F.col("t").cast("timestamp")) - F.unix_seconds(F.col("lo").cast("timestamp"))
    return df.select(*by, "t").distinct().join(spans, list(by)).where(gap % seconds != 0).select(*by, "t")


def _phase(seconds: int | str) -> Column:
    """How far, in microseconds, a stamp is past the grid that midnight is on. seconds: the step, or a column with it."""
    step = F.col(seconds) if isinstance(seconds, str) else F.lit(seconds)
    return F.pmod(F.unix_micros(F.col("t").cast("timestamp")), step * 1_000_000)


def usual_step(df: DataFrame, by: tuple[str, ...] = ("site",), name: str = "step", share: float = 0.05) -> DataFrame:
    """`by`, step: the least difference in seconds that a `share` of neighbouring stamps (two at least) have, so that neither holes nor stray stamps decide it; no row where there is none."""
    gap = F.unix_seconds(F.col("t").cast("timestamp")) - F.unix_seconds(F.lag("t").over(Window.partitionBy(*by).orderBy("t")).cast("timestamp"))
    gaps = df.where(F.col("t").isNotNull()).select(*by, "t", gap.alias("d")).where("d > 0").groupBy(*by, "d").agg(F.count("*").alias("n"))
    gaps = gaps.withColumn("all", F.sum("n").over(Window.partitionBy(*by)))
    return gaps.where(F.col("n") >= F.greatest(F.lit(2), share * F.col("all"))).groupBy(*by).agg(F.min("d").alias(name))


def series_verdicts(df: DataFrame, seconds: int | str = 1800, by: tuple[str, ...] = ("site",), least: int = 12, most_off: int = 1) -> DataFrame:
    """`by`, rows, missing (null stamps), duplicates, phase (of the grid that most stamps are on, in microseconds; ties: the least), off_grid (other stamps), verdict of every series.

    verdict: `short` for under `least` stamps, `irregular` for over most_off stamps off the grid, `repaired` where a stamp is left out or doubled, else `ok`.
    The grid is the majority's, so a stray first stamp doesn't decide it.
    """
    stamps = df.groupBy(*by, "t", *([seconds] if isinstance(seconds, str) and seconds not in by else [])).agg(F.count("*").alias("n"))
    phases = stamps.groupBy(*by, F.when(F.col("t").isNotNull(), _phase(seconds)).alias("p")).agg(F.count("t").alias("k"), F.sum("n").alias("n"))
    own = phases.groupBy(*by).agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("p").isNull(), F.col("n"))), F.lit(0)).alias("missing"), F.sum(F.when(F.col("p").isNotNull(), F.col("n") - F.col("k")).otherwise(0)).alias("duplicates"),
        F.sum("k").alias("stamps"), F.max(F.when(F.col("p").isNotNull(), F.struct("k", (-F.col("p")).alias("p")))).alias("most"),
    )
    own = own.select(*by, "rows", "missing", "duplicates", (-F.col("most.p")).alias("phase"), (F.col("stamps") - F.coalesce("most.k", F.lit(0))).alias("off_grid"))
    verdict = F.when(F.col("rows") - F.col("missing") < least, "short").when(F.col("off_grid") > most_off, "irregular").when(F.col("off_grid") + F.col("duplicates") + F.col("missing") > 0, "repaired").otherwise("ok")
    return own.withColumn("verdict", verdict)


def on_grid(df: DataFrame, verdicts: DataFrame, seconds: int | str = 1800, by: tuple[str, ...] = ("site",), fail: bool = True) -> DataFrame:
    """df without the stamps off their series' grid. A short or irregular series fails the job; or (fail=False) it is left out, and the verdicts say so."""
    bad = F.col("verdict").isin("short", "irregular")
    said = F.concat(F.lit("Time stamps can't be repaired: "), F.concat_ws(" ", *(F.col(c).cast("string") for c in by), "verdict"), F.lit(", off the grid: "), F.col("off_grid").cast("string"), F.lit(", rows: "), F.col("rows").cast("string"))
    step = [seconds] if isinstance(seconds, str) and seconds not in df.columns else []  # a column of the verdicts
    got = df.join(verdicts.select(*by, *step, "verdict", "phase", "off_grid", "rows"), list(by))
    keep = F.when(bad, F.raise_error(said).cast("boolean") if fail else F.lit(False)).otherwise(_phase(seconds) == F.col("phase"))
    return got.where(keep).select(*df.columns)


def strict_repair(df: DataFrame, seconds: int = 1800, by: tuple[str, ...] = ("site",), order: tuple[str, ...] = (), fill_gaps: bool = True, least: int = 12, most_off: int = 1, fail: bool = True) -> tuple[DataFrame, DataFrame]:
    """repair_time() of the series that allow it, and the verdicts of all: nothing is lost without a word. See on_grid()."""
    verdicts = series_verdicts(df, seconds, by, least, most_off)
    return repair_time(on_grid(df, verdicts, seconds, by, fail), f"{seconds} SECONDS", by, order, fill_gaps), verdicts


def parse_stamps(df: DataFrame, text: str, formats: list[str], by: str) -> DataFrame:
    """df with t, parsed by the one format that parses all of a file's stamps; null for files where none or several do."""
    tries = [F.try_to_timestamp(F.col(text), F.lit(f)).cast("timestamp_ntz").alias(f"_t{i}") for i, f in enumerate(formats)]
    own = df.select("*", *tries)
    bad = own.groupBy(by).agg(*(F.count_if(F.col(f"_t{i}").isNull()).alias(f"_b{i}") for i in range(len(formats))))
    fits = sum(((F.col(f"_b{i}") == 0).cast("int") for i in range(len(formats))), F.lit(0))
    chosen = F.coalesce(*(F.when((F.col(f"_b{i}") == 0) & (F.col("_fits") == 1), F.col(f"_t{i}")) for i in range(len(formats))))
    return own.join(bad.withColumn("_fits", fits), by).withColumn("t", chosen).select(*df.columns, "t")


def union_by_time(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Series put below each other; `source` ranks them, earlier ones first."""
    out = first.withColumn("source", F.lit(0))
    for i, df in enumerate(others):
        out = out.unionByName(df.withColumn("source", F.lit(i + 1)), allowMissingColumns=True)
    return out


def outer_join_meteo(flux: DataFrame, meteo: DataFrame, suffix: str | None = "_meteo") -> DataFrame:
    """Full outer join on (site, t). Columns in both: kept side by side with the suffix, or (None) the meteorological one wins."""
    both = [c for c in flux.columns if c in meteo.columns and c not in ("site", "t")]
    if suffix is None:
        return flux.drop(*both).join(meteo, ["site", "t"], "full_outer")
    return flux.join(meteo.withColumnsRenamed({c: c + suffix for c in both}), ["site", "t"], "full_outer")


def has_meteo(joined: DataFrame, last: str) -> DataFrame:
    """site, has_meteo: does the weather's last column have any value at the site after the join? Where not, the ranges do not meet, and the site counts as without weather."""
    return joined.groupBy("site").agg((F.count(last) > 0).alias("has_meteo"))


def split_by_interval(df: DataFrame, kind: str = "all", least: int = 5) -> DataFrame:
    """df with `interval`, the label of its export: for `all`, the site's first and last year (22-24; 2024 if one), for `year` 2024, for `month` 03.2024. Intervals of a site with under `least` rows are left out."""
    if kind == "all":
        whole = Window.partitionBy("site")
        lo, hi = F.min(F.year("t")).over(whole), F.max(F.year("t")).over(whole)
        label = F.when(lo == hi, lo.cast("string")).otherwise(F.concat_ws("-", (lo % 100).cast("string"), (hi % 100).cast("string")))
    else:
        label = F.date_format("t", {"year": "yyyy", "month": "MM.yyyy"}[kind])
    own = df.withColumn("interval", label)
    return own.withColumn("_n", F.count("*").over(Window.partitionBy("site", "interval"))).where(F.col("_n") >= least).drop("_n")


def snap_interval(df: DataFrame, unit: str = "month", least: int = 5, step: str = "30 MINUTES") -> DataFrame:
    """Whole months or years of the grid: a leading or trailing one with under `least` rows is dropped, others are completed with nulls."""
    own = df.withColumn("_u", F.date_trunc(unit, F.col("t").cast("timestamp")).cast("timestamp_ntz"))
    n = own.groupBy("site", "_u").agg(F.count("*").alias("_n"))
    ends = Window.partitionBy("site")
    n = n.withColumns({"_first": F.min("_u").over(ends), "_last": F.max("_u").over(ends)})
    kept = n.where(f"_n >= {least} or (_u <> _first and _u <> _last)").groupBy("site").agg(F.min("_u").alias("lo"), F.max("_u").alias("last"))
    kept = kept.withColumn("hi", F.expr(f"timestampadd({unit}, 1, last) - INTERVAL {step}"))
    return grid(kept, step, ["site"]).join(df, ["site", "t"], "left")


def interval_labels(step: str = "30 MINUTES") -> dict[str, Column]:
    """START and END stamps as text, and DTime: day of year of the end with the day's fraction."""
    end = F.expr(f"t + INTERVAL {step}")
    fraction = (F.hour(end) * 60 + F.minute(end)) / 1440
    return {"timestamp_start": F.date_format("t", "yyyyMMddHHmm"), "timestamp_end": F.date_format(end, "yyyyMMddHHmm"), "dtime": F.round(F.dayofyear(end) + fraction, 3)}


def season(kind: str = "continuous") -> Column:
    """year-month of the season's start month (3, 6, 9, 12). Continuous: December belongs to the next year's winter; within_year: to its own year's."""
    month, year = F.month("t"), F.year("t")
    start = F.when(month.isin(12, 1, 2), 12).otherwise((F.floor(month / 3) * 3).cast("int"))
    of = year + (month == 12).cast("int") if kind == "continuous" else year
    return F.concat(of.cast("string"), F.lit("-"), F.lpad(start.cast("string"), 2, "0"))


def missing_extra(df: DataFrame, start: str, stop: str, step: str = "30 MINUTES") -> DataFrame:
    """site, t, problem: stamps of the full period that are missing, and stamps beyond it or off its grid."""
    sites = df.select("site").distinct()
    full = sites.select("site", F.explode(F.expr(f"sequence(timestamp_ntz'{start}', timestamp_ntz'{stop}', INTERVAL {step})")).alias("t"))
    own = df.select("site", "t").distinct()
    return full.join(own, ["site", "t"], "left_anti").withColumn("problem", F.lit("missing")).union(own.join(full, ["site", "t"], "left_anti").withColumn("problem", F.lit("extra")))


def head_per_site(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy("site").orderBy("t"))).where(F.col("_r") <= n).drop("_r")


def skip_to_first_half_hour(df: DataFrame) -> DataFrame:
    """From each site's first stamp at 00:30 on."""
    first = F.min(F.when((F.hour("t") == 0) & (F.minute("t") == 30), F.col("t"))).over(Window.partitionBy("site"))
    return df.withColumn("_f", first).where("t >= _f").drop("_f")


def time_range(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n"))


def slot(seconds: int = 1800) -> Column:
    """The step of the day, from 0."""
    return ((F.hour("t") * 3600 + F.minute("t") * 60) / seconds).cast("int")
