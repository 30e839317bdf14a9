"""Export tables. Each is a projection with missing codes; writing is one partitioned write, units go to a sidecar table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.filters import diurnal_mean
from ..operators.gapfill import fill_diurnal
from ..operators.timegrid import interval_labels, skip_to_first_half_hour


def coded(value: Column, code: float = -9999.0) -> Column:
    return F.coalesce(value.cast("double"), F.lit(code))


def level3(wide: DataFrame) -> DataFrame:
    """Year, DoY, Hour and the level-3 variables, from the first 00:30 on. wide: site, t, nee, le, h, swin, ta, rh, vpd, u_star."""
    own = skip_to_first_half_hour(wide)
    names = {"nee": "NEE", "le": "LE", "h": "H", "swin": "Rg", "ta": "Tair", "ts": "Tsoil", "rh": "rH", "vpd": "VPD", "u_star": "Ustar", "ch4_flux": "CH4flux"}
    hour = F.hour("t") + F.minute("t") / 60
    return own.select("site", F.year("t").alias("Year"), F.dayofyear("t").alias("DoY"), hour.alias("Hour"), *(coded(F.col(a)).alias(b) for a, b in names.items() if a in own.columns))


def ias(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Level 2, of unfiltered data: interval stamps, DTime, exchange names; vapour pressure deficit in hPa. keep: columns that stay beside the site."""
    names = {"co2_flux": "FC_1_1_1", "le": "LE_1_1_1", "h": "H_1_1_1", "u_star": "USTAR_1_1_1", "ta": "TA_1_1_1", "rh": "RH_1_1_1", "swin": "SW_IN_1_1_1", "p_rain": "P_RAIN_1_1_1"}
    labels = interval_labels()
    own = [coded(F.col(a)).alias(b) for a, b in names.items() if a in wide.columns]
    vpd = [coded(F.col("vpd") * 10).alias("VPD_PI_1_1_1")] if "vpd" in wide.columns else []
    return wide.select("site", *keep, F.year("t").alias("year"), labels["timestamp_start"].alias("TIMESTAMP_START"), labels["timestamp_end"].alias("TIMESTAMP_END"), labels["dtime"].alias("DTime"), *own, *vpd)


def fat(long: DataFrame, least: int = 5) -> DataFrame:
    """site, year, DoY (3 decimals), period, var, value and its gap-filled form; years of a site with under `least` rows are left out."""
    own = fill_diurnal(long)
    doy = F.round(F.dayofyear("t") + F.hour("t") / 24.0 + F.minute("t") / 24.0 / 60.0, 3)
    own = own.select("site", F.year("t").alias("year"), doy.alias("DoY"), (F.floor((F.month("t") % 12) / 3) + 1).cast("int").alias("period"), "var", coded(F.col("value"), -99999.0).alias("value"), F.col("filled").alias("gapfilled"))
    return own.withColumn("_n", F.count("*").over(Window.partitionBy("site", "var", "year"))).where(F.col("_n") >= least).drop("_n")


def output_all(df: DataFrame, flags: list[str]) -> DataFrame:
    """Every value and flag with date and time as text; null as the code."""
    return df.select("site", F.date_format("t", "yyyy-MM-dd").alias("date"), F.date_format("t", "HH:mm").alias("time"), "var", coded(F.col("value")).alias("value"), *flags)


def summary(df: DataFrame, ok: str = "ok") -> DataFrame:
    """date, time, DoY, raw, filtered, flag and the 10- and 30-day diurnal means (of at least 7 values) of what is kept; codes for null."""
    kept = F.when(F.col(ok) == 1, F.col("value"))
    own = df.withColumn("kept", kept)
    means = {f"mean_{d}": F.round(coded(diurnal_mean(F.col("kept"), d, 7)), 8) for d in (10, 30)}
    own = own.withColumns(means)
    return own.select("site", F.date_format("t", "yyyy-MM-dd").alias("date"), F.date_format("t", "HH:mm").alias("time"), F.dayofyear("t").alias("doy"), "var", coded(F.col("value")).alias("raw"), coded(F.col("kept")).alias("filtered"), F.col(ok).alias("flag"), *means)


#: Weather variables of the summary, which come with indices.
WEATHER = ("ta", "rh", "vpd", "swin", "ppfd", "p")


def summary_variables(df: DataFrame) -> DataFrame:
    """Series (site, var, ...) under their names in the summary: of a weather variable's indexed series (`ta_1_1_1`, up to four indices of 1 to 9) each site's first counts and loses its indices, the others go. mean_name: what its diurnal means are called (ppfd's: rg)."""
    stem = F.regexp_extract("var", f"^({'|'.join(WEATHER)})(_[1-9]){{1,4}}$", 1)
    own = df.withColumn("_stem", F.when(stem != "", stem))
    first = own.where("_stem is not null").groupBy("site", "_stem").agg(F.min("var").alias("_first"))
    own = own.join(first, ["site", "_stem"], "left").where("_stem is null or var = _first")
    var = F.coalesce("_stem", "var")
    return own.withColumns({"var": var, "mean_name": F.when(var == "ppfd", "rg").otherwise(var)}).drop("_stem", "_first")


def averages(means: DataFrame, level: str, values: list[str]) -> DataFrame:
    """One level of the calendar means, Hour as HH:mm, codes for null."""
    minutes = F.round(F.col("hour") * 60).cast("int")
    hour = F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), minutes % 60)
    return means.where(F.col("level") == level).select("site", "year", "month", "dom", "doy", F.when(F.col("hour").isNotNull(), hour).alias("hour"), *(coded(F.col(v)).alias(v) for v in values))


def filled_table(raw: DataFrame, results: DataFrame, columns: list[str]) -> DataFrame:
    """The input with the results beside it, by key."""
    return raw.join(results.select("site", "t", *columns), ["site", "t"])


def fluxnet15(wide: DataFrame) -> DataFrame:
    """site, year, the stamps of the intervals that end at t, and the variables by their exchange names; vapour pressure deficit in hPa."""
    names = {"nee": "NEE_VUT_REF", "le": "LE_F_MDS", "h": "H_F_MDS", "swin": "SW_IN_F_MDS", "ta": "TA_F_MDS", "ts": "TS_F_MDS_1", "rh": "RH", "vpd": "VPD_F_MDS", "u_star": "USTAR"}
    stamp = lambda t: F.date_format(t, "yyyyMMddHHmm")
    own = [coded(F.col(a) * 10 if a == "vpd" else F.col(a)).alias(b) for a, b in names.items() if a in wide.columns]
    return wide.select("site", F.year("t").alias("year"), stamp(F.expr("t - INTERVAL 30 MINUTES")).alias("TIMESTAMP_START"), stamp(F.col("t")).alias("TIMESTAMP_END"), *own)


def write(df: DataFrame, path: str, by: list[str], fmt: str = "csv", units: dict[str, str] | None = None) -> None:
    """One partitioned write; units as a small table beside it."""
    df.write.mode("overwrite").partitionBy(*by).options(header=True).format(fmt).save(path)
    if units:
        df.sparkSession.createDataFrame(list(units.items()), "column string, unit string").coalesce(1).write.mode("overwrite").json(f"{path}_units")


def write_tables(df: DataFrame, path: str, by: Sequence[str], order: Sequence[str], units: Mapping[str, str] | None = None, separator: str = ",", code: str = "-9999") -> None:
    """One text file for each combination of `by`, in its folder: a line of names, one of units (if given; -- for columns without), then the rows in order; null as the code.

    Rows are brought together by `by` once and written as they are sorted, so a combination has to fit the disk of one task: a station's years do.
    """
    names = [c for c in df.columns if c not in by]
    head = [separator.join(names), *([separator.join(units.get(c, "--") for c in names)] if units else [])]
    line = F.concat_ws(separator, *(F.coalesce(F.col(c).cast("string"), F.lit(code)) for c in names))
    first = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) == 1
    own = df.withColumn("_first", first).withColumn("value", F.when(F.col("_first"), F.concat_ws("\n", *map(F.lit, head), line)).otherwise(line))
    own.sortWithinPartitions(*by, *order).select(*by, "value").write.mode("overwrite").partitionBy(*by).text(path)
