"""Queries of derived drivers, names and scalar expressions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import calendar, derive, gapfill, tables
from .stations import T, meteo, obs, query, table, text, wide

E = "pow(10.0, 23.5518 - 2937.4 / (air + 273.15) - 4.9283 * log10(air + 273.15))"


def row(df, **columns):
    return df.select("site", text().alias("t"), *(F.round(c, 8).alias(n) for n, c in columns.items()))


def column(expr: str, name: str, source: str = "meteo") -> str:
    return f"SELECT site, {T}, round({expr}, 8) AS {name} FROM {source}"


@query("pr1_rename_vocabulary", f"SELECT site, CASE var WHEN 'co2_flux' THEN 'fc' WHEN 'h' THEN 'sensible' ELSE var END AS var, count(*) AS n FROM obs GROUP BY 1, 2")
def pr1(spark, d):
    return tables.rename_vocabulary(obs(spark, d), {"co2_flux": "FC", "h": "Sensible"}).groupBy("site", "var").agg(F.count("*").alias("n"))


@query("pr2_rename_regex", "SELECT event_id, CASE WHEN regexp_matches(name, '^(?:s.*)') THEN 'second' WHEN regexp_matches(name, '^(?:[a-c].*)') THEN 'first' ELSE name END AS name FROM (SELECT event_id, event_type AS name FROM events)")
def pr2(spark, d):
    return table(spark, d, "events").select("event_id", tables.rename_regex(F.col("event_type"), {"[a-c].*": "first", "s.*": "second"}).alias("name"))


@query("pr3_normalise_case", "SELECT event_id, upper(event_type) AS name, CASE WHEN event_type IN ('view', 'click') THEN upper(event_type[1]) || event_type[2:] END AS fixed FROM events")
def pr3(spark, d):
    own = table(spark, d, "events").select("event_id", F.upper("event_type").alias("name"))
    return tables.normalise_case(own, ["View", "Click"])


@query("pr4_verify_columns", "SELECT file, name, 'missing' AS problem FROM (SELECT DISTINCT file FROM h) CROSS JOIN (VALUES ('view'), ('click'), ('other')) v(name) WHERE (file, name) NOT IN (SELECT file, name FROM h) UNION ALL SELECT file, name, 'unknown' FROM h WHERE name NOT IN ('view', 'click', 'error')", "h AS (SELECT DISTINCT user_id AS file, event_type AS name FROM events)")
def pr4(spark, d):
    own = table(spark, d, "events").select(F.col("user_id").alias("file"), F.col("event_type").alias("name")).distinct()
    return tables.verify_columns(own, ["view", "click", "other"], ["view", "click", "error"])


@query("pr5_station_renames", "SELECT DISTINCT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'u_star' WHEN 1 THEN 'co2_signal_strength' WHEN 2 THEN 'swin_1_1_1' ELSE 'ppfd_1_1_1' END AS name FROM supplier")
def pr5(spark, d):
    i = F.col("s_suppkey") % 4
    raw = F.when(i == 0, "u*").when(i == 1, "CO2_signal_strength_7500_mean").when(i == 2, "SW_IN_1_1_1").otherwise("PPFD_IN_1_1_1")
    return table(spark, d, "supplier").select("s_suppkey", tables.station_name(raw).alias("name"))


@query("pr6_prune_scenario_columns", "SELECT site, count(*) AS columns_nee_f, count(*) AS columns_nee_u50_f FROM wide GROUP BY 1")
def pr6(spark, d):
    own = wide(spark, d).select("site", *(F.lit(1).alias(c) for c in ("NEE_uStar_f", "NEE_U50_f", "NEE_U50_fqc")))
    kept = tables.prune_scenario_columns(own.columns)
    named = own.withColumnRenamed("NEE_uStar_f", "NEE_f").select(*kept)
    return named.groupBy("site").agg(F.count("NEE_f").alias("columns_nee_f"), F.count("NEE_U50_f").alias("columns_nee_u50_f"))


@query("pr7_order_columns", f"SELECT site, {T}, co2_flux, nee, h FROM wide")
def pr7(spark, d):
    own = wide(spark, d).select("site", text().alias("t"), "h", "nee", "co2_flux")
    return own.select(*tables.order_columns(own.columns, {"co2_flux": "nee"}))


@query("pr8_unit_convert_vpd", f"SELECT site, {T}, round(rh * 0.1, 8) AS kpa, round(rh * 0.1 * 10, 8) AS hpa FROM meteo")
def pr8(spark, d):
    return row(meteo(spark, d), kpa=derive.kpa(F.col("rh")), hpa=derive.hpa(derive.kpa(F.col("rh"))))


LACK = "lack AS (SELECT *, CASE WHEN site IN ('S0', 'S2') THEN NULL WHEN rh < 50 THEN NULL ELSE swin END AS s FROM meteo), gone AS (SELECT site, count(s) = 0 AS gone FROM lack GROUP BY site)"


def lacking(spark, d):
    """Radiation that some stations lack altogether, and others at times."""
    return meteo(spark, d).withColumn("s", F.when(F.col("site").isin("S0", "S2") | (F.col("rh") < 50), None).otherwise(F.col("swin")))


@query("pr9_derive_ppfd_swin", f"SELECT site, {T}, round(CASE WHEN gone THEN rh * 0.46 ELSE s END, 8) AS swin, round(rh / 0.46, 8) AS ppfd FROM lack JOIN gone USING (site)", LACK)
def pr9(spark, d):
    own = derive.where_absent(lacking(spark, d), "s", derive.swin_from_ppfd(F.col("rh")))
    return row(own, swin=F.col("s"), ppfd=derive.ppfd_from_swin(F.col("rh")))


@query("pr10_derive_rg_swin", f"SELECT site, {T}, CASE WHEN gone THEN rh ELSE s END AS rg FROM lack JOIN gone USING (site)", LACK)
def pr10(spark, d):
    return row(derive.where_absent(lacking(spark, d), "s", F.col("rh")), rg=F.col("s"))


@query("pr11_derive_p_rain", f"SELECT site, {T}, CASE WHEN gone THEN rain ELSE s END AS p_rain FROM lack JOIN gone USING (site)", LACK)
def pr11(spark, d):
    return row(derive.where_absent(lacking(spark, d), "s", F.col("rain")), p_rain=F.col("s"))


@query("pr12_derive_vpd_rh", f"SELECT site, {T}, round({E} - {E} * rh / 100, 6) AS vpd, round(100 * (1 - ({E} - {E} * rh / 100) / {E}), 6) AS rh_back, round({E}, 6) AS rh_compat FROM meteo")
def pr12(spark, d):
    vpd = derive.vpd_from_rh(F.col("air"), F.col("rh"))
    return meteo(spark, d).select("site", text().alias("t"), F.round(vpd, 6).alias("vpd"), F.round(derive.rh_from_vpd(F.col("air"), vpd), 6).alias("rh_back"), F.round(derive.rh_from_vpd(F.col("air"), vpd, compat=True), 6).alias("rh_compat"))


@query("pr13_derive_par", f"SELECT site, {T}, round(swin / 0.47, 8) AS par, round(rh * 0.47, 8) AS swin FROM meteo")
def pr13(spark, d):
    return row(meteo(spark, d), par=derive.par_from_swin(F.col("swin")), swin=derive.swin_from_par(F.col("rh")))


@query("pr14_fallback_ta", f"SELECT site, {T}, round(CASE WHEN gone THEN rh + 200 - 273.15 ELSE s END, 8) AS ta FROM lack JOIN gone USING (site)", LACK)
def pr14(spark, d):
    return row(derive.where_absent(lacking(spark, d), "s", derive.celsius(F.col("rh") + 200)), ta=F.col("s"))


@query("pr15_derive_nee", f"SELECT site, {T}, round(co2_flux + h, 8) AS nee, co2_flux AS plain FROM wide")
def pr15(spark, d):
    return wide(spark, d).select("site", text().alias("t"), F.round(derive.nee(F.col("co2_flux"), F.col("h")), 8).alias("nee"), derive.nee(F.col("co2_flux")).alias("plain"))


@query("pr17_vpd_from_rh_tair", column("6.1078 * exp(17.08085 * air / (234.175 + air)) * (1 - rh / 100)", "vpd"))
def pr17(spark, d):
    return row(meteo(spark, d), vpd=derive.magnus_vpd(F.col("air"), F.col("rh")))


LAT, LON, TZ = 55.8, 37.6, 3.0
Y = f"(2 * {math.pi!r}::DOUBLE * (dayofyear(t) - 1) / 365.24)"
DECL = f"(0.006918::DOUBLE - 0.399912 * cos({Y}) + 0.070257 * sin({Y}) - 0.006758 * cos(2 * {Y}) + 0.000907 * sin(2 * {Y}) - 0.002697 * cos(3 * {Y}) + 0.00148 * sin(3 * {Y}))"
EQ = f"(0.0072::DOUBLE * cos({Y}) - 0.0528 * cos(2 * {Y}) - 0.0012 * cos(3 * {Y}) - 0.1229 * sin({Y}) - 0.1565 * sin(2 * {Y}) - 0.0041 * sin(3 * {Y}))"
SINE = f"(sin({DECL}) * {math.sin(math.radians(LAT))!r}::DOUBLE + cos({DECL}) * {math.cos(math.radians(LAT))!r}::DOUBLE * cos((hour(t) + minute(t) / 60 + {LON / 15 - TZ!r}::DOUBLE + {EQ} - 12) * {math.pi!r}::DOUBLE / 12))"
POTENTIAL = f"CASE WHEN {SINE} > 0 THEN 1366.1::DOUBLE * (1 + 0.034 * cos({Y})) * {SINE} ELSE 0 END"


def sun(f):
    return f(F.dayofyear("t"), F.hour("t") + F.minute("t") / 60, LAT, LON, TZ)


@query("pr18_potential_radiation_rep", f"SELECT site, {T}, round({POTENTIAL}, 5) AS rg FROM meteo")
def pr18(spark, d):
    return meteo(spark, d).select("site", text().alias("t"), F.round(sun(derive.potential_radiation), 5).alias("rg"))


@query("pr19_clear_sky_radiation", f"SELECT site, {T}, round((1160 + 75 * sin(2 * {math.pi!r}::DOUBLE * (dayofyear(t) - 275) / 365)) * exp(-(0.174 + 0.035 * sin(2 * {math.pi!r}::DOUBLE * (dayofyear(t) - 100) / 365)) / sin(radians(greatest(degrees(asin({SINE})), 0.001)))), 5) AS rg FROM meteo")
def pr19(spark, d):
    return meteo(spark, d).select("site", text().alias("t"), F.round(sun(derive.clear_sky_radiation), 5).alias("rg"))


@query("pr20_date_parts", f"SELECT site, {T}, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS dom, CAST(dayofyear(t) AS INTEGER) AS doy, hour(t) + minute(t) / 60 AS hour, CAST(month(t) % 12 // 3 + 1 AS INTEGER) AS period, strftime(t, '%H:%M') AS hhmm FROM meteo")
def pr20(spark, d):
    return meteo(spark, d).select("site", text().alias("t"), *(c.alias(n) for n, c in calendar.date_parts().items()))


@query("pr22_nee_uncertainty", f"SELECT site, {T}, round((h - le) / (2 * 1.96), 8) AS fsdu, round(sqrt(ta * ta + ((h - le) / (2 * 1.96)) * ((h - le) / (2 * 1.96))), 8) AS fsdug FROM wide")
def pr22(spark, d):
    spread, both = gapfill.nee_uncertainty(F.col("le"), F.col("h"), F.col("ta"))
    return row(wide(spark, d), fsdu=spread, fsdug=both)


@query("pr24_clip_bounds", f"SELECT site, {T}, CASE WHEN rh IS NOT NULL THEN least(rh, 90) END AS high, CASE WHEN rh IS NOT NULL THEN greatest(rh, 20) END AS low FROM meteo")
def pr24(spark, d):
    return row(meteo(spark, d), high=derive.clip(F.col("rh"), high=90.0), low=derive.clip(F.col("rh"), low=20.0))


@query("pr25_keep_extra_columns", f"SELECT site, {T}, u_star, rh FROM meteo")
def pr25(spark, d):
    own = meteo(spark, d)
    return own.select("site", text().alias("t"), *tables.keep_existing(own, ["u_star", "season", "rh", "theoretical_rg"]))


@query("pr26_carry_units", "SELECT var AS column, CASE var WHEN 'ta' THEN 'degC' WHEN 'h' THEN 'W m-2' ELSE '--' END AS unit FROM (SELECT DISTINCT var FROM obs)")
def pr26(spark, d):
    units = spark.createDataFrame([("ta", "degC"), ("h", "W m-2"), ("le_f", "W m-2")], "column string, unit string")
    return calendar.restore_units(obs(spark, d).select(F.col("var").alias("column")).distinct(), units)


@query("cl1_null_missing_codes", "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN value END AS value FROM events")
def cl1(spark, d):
    i = F.col("event_id") % 5
    raw = F.when(i == 0, "-9999").when(i == 1, " NAN ").when(i == 2, "abc").when(i == 3, "NaN").otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", tables.null_codes(raw).alias("value"))


@query("cl2_non_numeric_positions", "SELECT event_id, 'x' || user_id AS raw FROM events WHERE event_id % 50 = 3")
def cl2(spark, d):
    raw = F.when(F.col("event_id") % 50 == 3, F.concat(F.lit("x"), F.col("user_id").cast("string"))).otherwise(F.col("value").cast("string"))
    return tables.non_numeric(table(spark, d, "events").select("event_id", raw.alias("raw")), "raw", ["event_id"])


@query("cl3_drop_empty_columns", f"SELECT site, var, {T}, value FROM obs WHERE NOT (site = 'S1' AND var = 'h')")
def cl3(spark, d):
    own = obs(spark, d).withColumn("value", F.when(~((F.col("site") == "S1") & (F.col("var") == "h")), F.col("value")))
    return tables.drop_empty(own).select("site", "var", text().alias("t"), "value")


@query("cl5_equal_columns", "SELECT * FROM (VALUES ('co2_flux', true), ('h', false)) v(name, same) WHERE (SELECT count(*) FROM wide) > 0")
def cl5(spark, d):
    own = wide(spark, d).select("site", "t", "co2_flux", "h")
    other = own.withColumn("h", F.when(F.col("h") > 0, F.col("h") + 1).otherwise(F.col("h")))
    return tables.equal_columns(own, other, ["site", "t"], ["co2_flux", "h"])
