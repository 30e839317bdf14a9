"""Derived drivers, as column expressions over the wide meteorological table. A variable is derived where a station lacks the
whole column (absent()), never for single missing values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shortwave radiation per unit of photon flux, and per unit of photosynthetic radiation.
SWIN_PER_PPFD, SWIN_PER_PAR = 0.46, 0.47
KELVIN = 273.15


def absent(name: str, by: str = "site") -> Column:
    """Does the station have no value of the column at all?"""
    return F.count(name).over(Window.partitionBy(by)) == 0


def where_absent(df: DataFrame, name: str, other: Column, as_name: str | None = None) -> DataFrame:
    """The column, replaced by another expression at stations that lack it."""
    return df.withColumn("_none", absent(name)).withColumn(as_name or name, F.when(F.col("_none"), other).otherwise(F.col(name))).drop("_none")


def ppfd_from_swin(swin: Column) -> Column:
    return swin / SWIN_PER_PPFD


def swin_from_ppfd(ppfd: Column) -> Column:
    return ppfd * SWIN_PER_PPFD


def par_from_swin(swin: Column) -> Column:
    return swin / SWIN_PER_PAR


def swin_from_par(par: Column) -> Column:
    return par * SWIN_PER_PAR


def saturation_pressure(ta: Column) -> Column:
    """Of water vapour, by air temperature in degrees C (as fitted for kelvins)."""
    kelvin = ta + KELVIN
    return F.pow(F.lit(10.0), 23.5518 - 2937.4 / kelvin - 4.9283 * F.log10(kelvin))


def vpd_from_rh(ta: Column, rh: Column) -> Column:
    e = saturation_pressure(ta)
    return e - e * rh / 100


def rh_from_vpd(ta: Column, vpd: Column, compat: bool = False) -> Column:
    """The inverse of vpd_from_rh(). compat: the original's result, the saturation pressure itself."""
    e = saturation_pressure(ta)
    return e if compat else 100 * (1 - F.try_divide(vpd, e))


def magnus_vpd(ta: Column, rh: Column) -> Column:
    """In hPa, by the Magnus form."""
    return 6.1078 * F.exp(17.08085 * ta / (234.175 + ta)) * (1 - rh / 100)


def celsius(kelvin: Column) -> Column:
    return kelvin - KELVIN


def kpa(hpa: Column) -> Column:
    return hpa * 0.1


def hpa(kpa: Column) -> Column:
    return kpa * 10


def nee(co2_flux: Column, storage: Column | None = None) -> Column:
    return co2_flux if storage is None else co2_flux + storage


def albedo(swin: Column, swout: Column | None, alb: Column | None = None) -> Column:
    """Null in the dark and without outgoing radiation; alb (percent) where there is no swout."""
    got = F.when((swin > 20) & (swout > 0), F.try_divide(swout, swin)) if swout is not None else alb / 100
    return got


def albedo_below_quantile(df: DataFrame, q: float = 0.95) -> DataFrame:
    """Albedo kept where it is under the site's quantile."""
    limit = df.groupBy("site").agg(F.percentile("albedo", F.lit(q)).alias("_q"))
    return df.join(limit, "site").withColumn("albedo", F.when(F.col("albedo") < F.col("_q"), F.col("albedo"))).drop("_q")


def solar_elevation_sine(doy: Column, hour: Column, lat: Column | float, lon: Column | float, tz: Column | float) -> Column:
    """Sine of the sun's elevation, by local standard time; the place is one for all rows, or columns of a table of stations."""
    lat, lon, tz = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lat, lon, tz))
    year_angle = 2 * math.pi * (doy - 1) / 365.24
    declination = 0.006918 - 0.399912 * F.cos(year_angle) + 0.070257 * F.sin(year_angle) - 0.006758 * F.cos(2 * year_angle) + 0.000907 * F.sin(2 * year_angle) - 0.002697 * F.cos(3 * year_angle) + 0.00148 * F.sin(3 * year_angle)
    equation = 0.0072 * F.cos(year_angle) - 0.0528 * F.cos(2 * year_angle) - 0.0012 * F.cos(3 * year_angle) - 0.1229 * F.sin(year_angle) - 0.1565 * F.sin(2 * year_angle) - 0.0041 * F.sin(3 * year_angle)
    angle = (hour + (lon / 15.0 - tz) + equation - 12) * math.pi / 12
    return F.sin(declination) * F.sin(F.radians(lat)) + F.cos(declination) * F.cos(F.radians(lat)) * F.cos(angle)


def potential_radiation(doy: Column, hour: Column, lat: Column | float, lon: Column | float, tz: Column | float) -> Column:
    """Extraterrestrial radiation on the horizontal, 0 at night."""
    distance = 1 + 0.034 * F.cos(2 * math.pi * (doy - 1) / 365.24)
    sine = solar_elevation_sine(doy, hour, lat, lon, tz)
    return F.when(sine > 0, 1366.1 * distance * sine).otherwise(0.0)


def clear_sky_radiation(doy: Column, hour: Column, lat: Column | float, lon: Column | float, tz: Column | float) -> Column:
    """Direct radiation under a clear sky, by a day-of-year flux and optical depth; elevations under 0 count as 0.001 degrees."""
    degrees = F.degrees(F.asin(solar_elevation_sine(doy, hour, lat, lon, tz)))
    elevation = F.radians(F.greatest(degrees, F.lit(0.001)))
    turn = 2 * math.pi * (doy - 275) / 365
    flux, depth = 1160 + 75 * F.sin(turn), 0.174 + 0.035 * F.sin(2 * math.pi * (doy - 100) / 365)
    return flux * F.exp(-depth / F.sin(elevation))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """One-sided or two-sided; null stays null."""
    got = value
    got = F.greatest(got, F.lit(low)) if low is not None else got
    got = F.least(got, F.lit(high)) if high is not None else got
    return F.when(value.isNotNull(), got)
