"""Queries of the quality filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar, filters
from .stations import T, full, gridded, query, text

LIMITS = {"co2_flux": (-4.5, 20.0), "h": (-4.0, 30.0), "le": (-5.0, 25.0)}
OUT = ("site", "var", "value")
KEEP = "site, var, value"


def out(df, *columns):
    return df.select(*OUT, text().alias("t"), *columns)


@query("fl1_qc_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN (var IN ('h', 'le') AND qc > 1) OR (var IN ('co2_flux', 'nee') AND qc > 0) THEN 0 ELSE 1 END AS INTEGER) AS f_qc FROM allv")
def fl1(spark, d):
    return out(filters.qc_filter(full(spark, d), {"h": 1, "le": 1, "co2_flux": 0, "nee": 2}), "f_qc")


@query("fl2_co2_signal_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN var IN ('co2_flux', 'nee') AND co2_signal_strength < 60 THEN 0 ELSE 1 END AS INTEGER) AS f FROM allv")
def fl2(spark, d):
    return out(filters.below(full(spark, d), "co2_signal_strength", 60.0, filters.CO2_VARS, "f"), "f")


@query("fl3_ch4_signal_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN var = 'le' AND ch4_signal_strength < 20 THEN 0 ELSE 1 END AS INTEGER) AS f FROM allv")
def fl3(spark, d):
    return out(filters.below(full(spark, d), "ch4_signal_strength", 20.0, ("le",), "f"), "f")


@query("fl4_rh_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN var IN ('co2_flux', 'le', 'nee') AND rh > 98 THEN 0 ELSE 1 END AS INTEGER) AS f FROM allv")
def fl4(spark, d):
    return out(filters.above(full(spark, d), "rh", 98.0, filters.RH_VARS, "f"), "f")


@query("fl5_rain_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN var IN ('co2_flux', 'h', 'le', 'nee') AND max(CASE WHEN p_rain > 0.125 THEN 1 WHEN p_rain IS NOT NULL THEN 0 END) OVER (PARTITION BY site, var ORDER BY t ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 1 THEN 0 ELSE 1 END AS INTEGER) AS f_rain FROM gridv")
def fl5(spark, d):
    return out(filters.rain_filter(gridded(spark, d), 0.125, 2), "f_rain")


NIGHT = "swin < 10 AND ((var = 'nee' AND value < -4) OR (var = 'co2_flux' AND value < 0) OR (var = 'h' AND (value < -4 OR value > 8)) OR (var = 'le' AND (value < -3 OR value > 9)))"


@query("fl6_night_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN {NIGHT} THEN 0 ELSE 1 END AS INTEGER) AS f_night FROM allv")
def fl6(spark, d):
    return out(filters.night_filter(full(spark, d), -4.0, (-4.0, 8.0), (-3.0, 9.0)), "f_night")


@query("fl7_day_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN var = 'nee' AND swin >= 10 AND value > 5 THEN 0 ELSE 1 END AS INTEGER) AS f_day FROM allv")
def fl7(spark, d):
    return out(filters.day_filter(full(spark, d), 10.0, 5.0), "f_day")


def winter(spark, d, kind: str):
    """Ranges of each site, from the first stamps of its data."""
    first = full(spark, d).groupBy("site").agg(F.date_trunc("day", F.min("t").cast("timestamp")).cast("timestamp_ntz").alias("a"))
    offsets = {"winter": ((2, 6), (5, 9)), "manual": ((10, 12),)}[kind]
    return first.select("site", F.explode(F.array(*(F.struct(F.expr(f"a + INTERVAL {i} DAYS").alias("start"), F.expr(f"a + INTERVAL {j} DAYS").alias("stop")) for i, j in offsets))).alias("r")).select("site", "r.*")


FIRST = "first AS (SELECT site, date_trunc('day', min(t)) AS a FROM allv GROUP BY site)"


@query("fl8_winter_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN (t BETWEEN a + INTERVAL 2 DAY AND a + INTERVAL 6 DAY OR t BETWEEN a + INTERVAL 5 DAY AND a + INTERVAL 9 DAY) AND var IN ('nee', 'co2_flux') AND (value < -3 OR value > 5) THEN 0 ELSE 1 END AS INTEGER) AS f_winter FROM allv JOIN first USING (site)", FIRST)
def fl8(spark, d):
    return out(filters.winter_filter(full(spark, d), winter(spark, d, "winter"), {"nee": (-3.0, 5.0), "co2_flux": (-3.0, 5.0)}), "f_winter")


@query("fl9_manual_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN t BETWEEN a + INTERVAL 10 DAY AND a + INTERVAL 12 DAY AND var = 'nee' THEN 0 ELSE 1 END AS INTEGER) AS f_manual FROM allv JOIN first USING (site)", FIRST)
def fl9(spark, d):
    return out(filters.manual_filter(full(spark, d), winter(spark, d, "manual")), "f_manual")


@query("fl10_min_max_filter", f"SELECT site, var, CASE WHEN var = 'rh' THEN least(value, 90) WHEN var = 'swin' THEN greatest(value, 5) ELSE value END AS value, {T}, CAST(CASE WHEN (var = 'co2_flux' AND (value < -4.5 OR value > 20)) OR (var = 'h' AND (value < -4 OR value > 30)) OR (var = 'rh' AND value < 10) OR (var = 'swin' AND value > 700) THEN 0 ELSE 1 END AS INTEGER) AS f_minmax FROM (SELECT site, t, var, value FROM obs UNION ALL SELECT site, t, 'rh', rh FROM meteo UNION ALL SELECT site, t, 'swin', swin FROM meteo)")
def fl10(spark, d):
    from .stations import meteo, obs

    both = obs(spark, d).select("site", "t", "var", "value")
    for v in ("rh", "swin"):
        both = both.unionByName(meteo(spark, d).select("site", "t", F.lit(v).alias("var"), F.col(v).alias("value")))
    return out(filters.min_max_filter(both, {"co2_flux": (-4.5, 20.0), "h": (-4.0, 30.0), "rh": (10.0, 90.0), "swin": (5.0, 700.0)}), "f_minmax")


CHAIN = """c1 AS (SELECT *, CASE WHEN (var IN ('h', 'le') AND qc > 1) OR (var IN ('co2_flux', 'nee') AND qc > 1) THEN 0 ELSE 1 END AS f_qc FROM gridv),
c2 AS (SELECT *, CASE WHEN (var = 'co2_flux' AND (value < -4.5 OR value > 20)) OR (var = 'h' AND (value < -4.0 OR value > 30)) OR (var = 'le' AND (value < -5 OR value > 25)) THEN 0 ELSE f_qc END AS f_minmax FROM c1),
q AS (SELECT site, var, quantile_cont(value, 0.02) FILTER (f_minmax = 1) AS lo, quantile_cont(value, 0.97) FILTER (f_minmax = 1) AS hi FROM c2 WHERE var IN ('co2_flux', 'h') GROUP BY site, var),
c3 AS (SELECT c2.*, CASE WHEN value < lo OR value > hi THEN 0 ELSE f_minmax END AS f_quantile FROM c2 LEFT JOIN q USING (site, var))"""


def chain(spark, d):
    own = filters.qc_filter(gridded(spark, d), {"h": 1, "le": 1, "co2_flux": 1, "nee": 1})
    own = filters.min_max_filter(own, LIMITS, before="f_qc")
    return filters.quantile_filter(own, {"co2_flux": (0.02, 0.97), "h": (0.02, 0.97)}, before="f_minmax")


FLAGS = ("f_qc", "f_minmax", "f_quantile")


@query("fl11_quantile_filter", f"SELECT {KEEP}, {T}, CAST(f_minmax AS INTEGER) AS f_minmax, CAST(f_quantile AS INTEGER) AS f_quantile FROM c3", CHAIN)
def fl11(spark, d):
    return out(chain(spark, d), "f_minmax", "f_quantile")


STD = CHAIN + """, s1 AS (SELECT *, CASE WHEN f_qc = 1 THEN value END AS x FROM c1 WHERE var IN ('co2_flux', 'h')),
s2 AS (SELECT *, CASE WHEN count(x) OVER w >= 2 THEN avg(x) OVER w END AS m FROM s1 WINDOW w AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)),
s3 AS (SELECT *, x - m AS r FROM s2), s4 AS (SELECT *, CASE WHEN count(r) OVER v >= 144 THEN stddev_samp(r) OVER v END AS s FROM s3 WINDOW v AS (PARTITION BY site, var ORDER BY t ROWS BETWEEN 145 PRECEDING AND 143 FOLLOWING))"""


@query("fl12_std_window_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN abs(value - m) > 1.5 * s THEN 0 ELSE f_qc END AS INTEGER) AS f_std FROM s4 UNION ALL SELECT {KEEP}, {T}, CAST(f_qc AS INTEGER) FROM c1 WHERE var NOT IN ('co2_flux', 'h')", STD)
def fl12(spark, d):
    own = filters.qc_filter(gridded(spark, d), {"h": 1, "le": 1, "co2_flux": 1, "nee": 1})
    return out(filters.std_window_filter(own, {"co2_flux": (1.5, 6, 2), "h": (1.5, 6, 2)}, before="f_qc"), "f_std")


HAMPEL = CHAIN + """, l AS (SELECT site, var, t, value, (value - lag(value) OVER o) - (lead(value) OVER o - value) AS dd FROM c1 WHERE f_qc = 1 AND value IS NOT NULL AND var IN ('co2_flux', 'h') WINDOW o AS (PARTITION BY site, var ORDER BY t)),
l1 AS (SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY site, var ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS m FROM l),
l2 AS (SELECT *, quantile_cont(abs(value - m), 0.5) OVER (PARTITION BY site, var ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS a FROM l1),
dm AS (SELECT site, var, quantile_cont(dd, 0.5) AS dm FROM l GROUP BY site, var),
da AS (SELECT site, var, quantile_cont(abs(dd - dm), 0.5) AS da FROM l JOIN dm USING (site, var) GROUP BY site, var),
bad AS (SELECT site, var, t FROM l2 JOIN dm USING (site, var) JOIN da USING (site, var) WHERE abs(dd - dm) > 3.5 * da / 0.6745 OR abs(value - m) > 3.5 * a / 0.6745)"""


@query("fl13_mad_hampel_filter", f"SELECT c1.site, c1.var, c1.value, strftime(c1.t, '%Y-%m-%d %H:%M:%S') AS t, CAST(CASE WHEN bad.t IS NOT NULL THEN 0 ELSE f_qc END AS INTEGER) AS f_hampel FROM c1 LEFT JOIN bad ON c1.site = bad.site AND c1.var = bad.var AND c1.t = bad.t", HAMPEL)
def fl13(spark, d):
    own = filters.qc_filter(gridded(spark, d), {"h": 1, "le": 1, "co2_flux": 1, "nee": 1})
    return out(filters.mad_hampel_filter(own, {"co2_flux": (3.5, 10), "h": (3.5, 10)}, before="f_qc"), "f_hampel")


@query("fl14_meteorological_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN (var = 'co2_flux' AND co2_signal_strength < 60) OR (var IN ('co2_flux', 'h', 'le', 'ch4_flux') AND max(CASE WHEN p_rain > 0.125 THEN 1 WHEN p_rain IS NOT NULL THEN 0 END) OVER (PARTITION BY site, var ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 1) OR (var IN ('co2_flux', 'le') AND rh > 98) THEN 0 ELSE 1 END AS INTEGER) AS f_phys FROM gridv")
def fl14(spark, d):
    return out(filters.meteorological_filter(gridded(spark, d), 60.0, 0.125, 3, 98.0), "f_phys")


@query("fl15_collapse_flags", f"SELECT {KEEP}, {T}, CAST(least(f_qc, f_minmax, f_quantile) AS INTEGER) AS ok FROM c3", CHAIN)
def fl15(spark, d):
    return out(filters.collapse_flags(chain(spark, d), FLAGS), "ok")


@query("fl16_apply_flags", f"SELECT {KEEP}, {T}, CASE WHEN f_quantile = 1 THEN value END AS filtered FROM c3", CHAIN)
def fl16(spark, d):
    return out(filters.apply_flags(filters.collapse_flags(chain(spark, d), FLAGS)), "filtered")


@query("fl17_undo_last_filter", f"SELECT {KEEP}, {T}, CAST(f_minmax AS INTEGER) AS ok FROM c2", CHAIN)
def fl17(spark, d):
    own, flags = filters.undo_last(chain(spark, d), FLAGS)
    return out(filters.collapse_flags(own, flags), "ok")


@query("ud1_custom_filter", f"SELECT {KEEP}, {T}, CAST(CASE WHEN var = 'h' AND value > 2 * rh / 10 THEN 0 WHEN qc > 1 AND var = 'h' THEN 0 ELSE 1 END AS INTEGER) AS f_own FROM allv")
def ud1(spark, d):
    own = filters.qc_filter(full(spark, d), {"h": 1})
    return out(filters.custom_filter(own, (F.col("var") == "h") & (F.col("value") > 2 * F.col("rh") / 10), "f_own", "f_qc"), "f_own")


@query("ag6_filter_attrition", "SELECT site, var, filter, CAST(entering AS BIGINT) AS entering, CAST(rejected AS BIGINT) AS rejected, round(100.0::DOUBLE * rejected / n, 8) AS percent FROM (SELECT site, var, count(*) AS n, unnest([{'filter': 'f_qc', 'entering': count(*), 'rejected': sum(1 - f_qc)}, {'filter': 'f_minmax', 'entering': sum(f_qc), 'rejected': sum(f_qc - f_minmax)}, {'filter': 'f_quantile', 'entering': sum(f_minmax), 'rejected': sum(f_minmax - f_quantile)}], recursive := true) FROM c3 GROUP BY site, var)", CHAIN)
def ag6(spark, d):
    return calendar.attrition(chain(spark, d), FLAGS)


@query("ag13_rejected_by_first_filter", "SELECT site, var, CASE WHEN f_qc = 0 THEN 'f_qc' WHEN f_minmax = 0 THEN 'f_minmax' WHEN f_quantile = 0 THEN 'f_quantile' ELSE 'good' END AS first, count(*) AS n FROM c3 GROUP BY 1, 2, 3", CHAIN)
def ag13(spark, d):
    return calendar.rejected_by_first(chain(spark, d), FLAGS)
