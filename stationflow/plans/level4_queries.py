"""Queries of thresholds, scenarios and partitioning."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import derive, gapfill, partition, ustar
from .derive_queries import DECL, EQ, Y
from .grid_queries import CLASS, PICK, SIMILAR
from .stations import T, meteo, query, table, text, wide


def nights(spark, d):
    """nee, ta, u_star, swin with a season (thirds of the month)."""
    return wide(spark, d).select("site", "t", "nee", "air", "swin", "u_star", F.col("air").alias("ta_"), F.concat(F.lit("P"), F.floor((F.dayofmonth("t") - 1) / 10).cast("string")).alias("season")).withColumnRenamed("ta_", "ta")


US = """n0 AS (SELECT site, t, nee, air AS ta, u_star, swin, 'P' || ((day(t) - 1) // 10) AS season FROM wide),
n1 AS (SELECT *, ntile(7) OVER (PARTITION BY site, season ORDER BY ta, t) AS tc FROM n0 WHERE swin < 10 AND nee IS NOT NULL),
n2 AS (SELECT *, ntile(20) OVER (PARTITION BY site, season, tc ORDER BY u_star, t) AS ub FROM n1),
n3 AS (SELECT site, season, tc, ub, avg(nee) AS m, avg(u_star) AS u FROM n2 GROUP BY 1, 2, 3, 4),
n4 AS (SELECT *, avg(m) OVER (PARTITION BY site, season, tc ORDER BY ub ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS later FROM n3),
us AS (SELECT site, season, quantile_cont(u, 0.5) AS ustar FROM (SELECT site, season, tc, arg_min(u, ub) AS u FROM n4 WHERE m > 0.95 * later GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


def thresholds(spark, d):
    return ustar.threshold(nights(spark, d))


@query("us1_ustar_threshold", "SELECT site, season, round(ustar, 8) AS ustar FROM us", US)
def us1(spark, d):
    return thresholds(spark, d).withColumn("ustar", F.round("ustar", 8))


@query("us1_ustar_yearly", "SELECT site, round(max(ustar), 8) AS ustar FROM us GROUP BY 1", US)
def us1_year(spark, d):
    return ustar.yearly(thresholds(spark, d)).withColumn("ustar", F.round("ustar", 8))


def plateau(of, by, source):
    """SQL of the thresholds of the rows of a table by `by`, as in US, each step named by a letter."""
    return f"""{of}2 AS (SELECT *, ntile(20) OVER (PARTITION BY {by}, tc ORDER BY u_star, t) AS ub FROM {source}),
{of}3 AS (SELECT {by}, tc, ub, avg(nee) AS m, avg(u_star) AS u FROM {of}2 GROUP BY ALL),
{of}4 AS (SELECT *, avg(m) OVER (PARTITION BY {by}, tc ORDER BY ub ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS later FROM {of}3),
{of}s AS (SELECT {by}, quantile_cont(u, 0.5) AS ustar FROM (SELECT {by}, tc, arg_min(u, ub) AS u FROM {of}4 WHERE m > 0.95 * later GROUP BY ALL) GROUP BY ALL)"""


POOLED = f"""{US}, k0 AS (SELECT *, count(*) OVER (PARTITION BY site, season) < 160 AS thin FROM n0 WHERE swin < 10 AND nee IS NOT NULL),
k1 AS (SELECT site, t, nee, ta, u_star, season AS name, false AS pooled FROM k0 WHERE NOT thin UNION ALL SELECT site, t, nee, ta, u_star, '', true FROM k0 WHERE site IN (SELECT site FROM k0 WHERE thin)),
k2 AS (SELECT *, ntile(7) OVER (PARTITION BY site, pooled, name ORDER BY ta, t) AS tc FROM k1),
k3 AS (SELECT site, pooled, name, tc FROM k2 GROUP BY ALL HAVING count(*) >= 20 AND NOT coalesce(abs(corr(ta, u_star)) > 0.2, false)),
{plateau("l", "site, pooled, name", "k2 SEMI JOIN k3 USING (site, pooled, name, tc)")},
kn AS (SELECT site, season, count(*) FILTER (swin < 10 AND nee IS NOT NULL) AS n FROM n0 GROUP BY ALL)"""


@query("us1_pooled_thresholds", "SELECT kn.site, kn.season, kn.n, kn.n < 160 AS pooled, round(ustar, 8) AS ustar FROM kn LEFT JOIN ls ON ls.site = kn.site AND ls.pooled = (kn.n < 160) AND ls.name = CASE WHEN kn.n < 160 THEN '' ELSE kn.season END", POOLED)
def us1_pooled(spark, d):
    """The series has one month, so classes need fewer rows here, and a lower bound of the correlation, to have some refused."""
    return ustar.pooled_thresholds(nights(spark, d), least_class=20, most_cor=0.2).withColumn("ustar", F.round("ustar", 8))


RESAMPLED = f"""b0 AS (SELECT site, t, nee, ta, u_star, season, unnest(range(50)) AS block FROM n0 WHERE swin < 10 AND nee IS NOT NULL),
b1 AS (SELECT *, md5(site || '|' || strftime(t, '%Y-%m-%d %H:%M:%S') || '|1|' || block) AS h, unnest(range(4)) AS i FROM b0),
b2 AS (SELECT site, season, t, nee, ta, u_star, 4 * block + i + 1 AS rep, (CAST('0x' || substr(h, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS x FROM b1),
b3 AS (SELECT * EXCLUDE x, unnest(range({' + '.join(f'CAST(x > {p!r}::DOUBLE AS BIGINT)' for p in ustar.POISSON)})) AS copy FROM b2),
b4 AS (SELECT *, ntile(7) OVER (PARTITION BY site, season, rep ORDER BY ta, t) AS tc FROM b3),
{plateau("e", "site, season, rep", "b4")}"""


@query("us2_ustar_bootstrap", "SELECT site, round(quantile_cont(ustar, 0.05), 7) AS U05, round(quantile_cont(ustar, 0.5), 7) AS U50, round(quantile_cont(ustar, 0.95), 7) AS U95 FROM (SELECT site, rep, max(ustar) AS ustar FROM es GROUP BY 1, 2) GROUP BY 1", US + ", " + RESAMPLED)
def us2(spark, d):
    """In SQL each row is copied as often as it is drawn; here it is weighted."""
    return ustar.bootstrap(nights(spark, d), 200).select("site", *(F.round(c, 7).alias(c) for c in ("U05", "U50", "U95")))


@query("us3_ustar_filter", f"SELECT site, {T}, CASE WHEN u_star < y AND swin < 10 THEN NULL ELSE nee END AS nee_ustar FROM n0 LEFT JOIN (SELECT site, max(ustar) AS y FROM us GROUP BY 1) USING (site)", US)
def us3(spark, d):
    got = ustar.ustar_filter(nights(spark, d), ustar.yearly(thresholds(spark, d)))
    return got.select("site", text().alias("t"), "nee_ustar")


@query("us4_ustar_fallback", "SELECT site, season, round(coalesce(ustar, 0.01), 8) AS ustar FROM (SELECT DISTINCT site, season FROM n0) LEFT JOIN (SELECT * FROM us WHERE season <> 'P1') USING (site, season)", US)
def us4(spark, d):
    seasons = nights(spark, d).select("site", "season").distinct()
    return ustar.fallback(thresholds(spark, d).where("season <> 'P1'"), seasons).withColumn("ustar", F.round("ustar", 8))


@query("us5_ustar_scenarios", f"SELECT site, {T}, scenario, CASE WHEN u_star < u AND swin < 10 THEN NULL ELSE nee END AS nee_ustar FROM n0 JOIN (SELECT site, unnest(['U05', 'U50', 'U95']) AS scenario, unnest([min(ustar), quantile_cont(ustar, 0.5), max(ustar)]) AS u FROM us GROUP BY 1) USING (site)", US)
def us5(spark, d):
    q = thresholds(spark, d).groupBy("site").agg(F.min("ustar").alias("U05"), F.percentile("ustar", F.lit(0.5)).alias("U50"), F.max("ustar").alias("U95"))
    return ustar.scenarios(nights(spark, d), q).select("site", text().alias("t"), "scenario", "nee_ustar")


SERIES = US + """, sv AS (SELECT site, 'nee' AS var, scenario, t, CASE WHEN u_star < u AND swin < 10 THEN NULL ELSE nee END AS value FROM n0 JOIN (SELECT site, unnest(['U05', 'U50', 'U95']) AS scenario, unnest([min(ustar), quantile_cont(ustar, 0.5), max(ustar)]) AS u FROM us GROUP BY 1) USING (site)
  UNION ALL SELECT site, 'h', '', t, h FROM wide UNION ALL SELECT site, 'le', '', t, le FROM wide),
v AS (SELECT site, var, scenario, t, value, swin AS rg, rh / 10 AS vpd, air AS ta, CAST(t AS DATE) AS day, hour(t) * 60 + minute(t) AS minute FROM sv JOIN (SELECT site, t, swin, rh, air FROM wide) USING (site, t)),
p AS (SELECT g.site, g.var, g.scenario, g.t, h.value, abs(date_diff('day', g.day, h.day)) AS off, abs(g.rg - h.rg) < 50 AS nr, abs(g.rg - h.rg) < 50 AND abs(g.vpd - h.vpd) < 5 AND abs(g.ta - h.ta) < 2.5 AS na, abs(g.minute - h.minute) <= 60 AS nm
  FROM v g JOIN v h ON g.site = h.site AND g.var = h.var AND g.scenario = h.scenario AND h.day BETWEEN g.day - 28 AND g.day + 28 WHERE (g.value IS NULL OR g.var <> 'le') AND h.value IS NOT NULL),
s AS (SELECT site, var, scenario, t, """ + ", ".join(f"count(*) FILTER ({SIMILAR[c]} AND off <= {n}) AS n{i}, avg(value) FILTER ({SIMILAR[c]} AND off <= {n}) AS a{i}, stddev_samp(value) FILTER ({SIMILAR[c]} AND off <= {n}) AS s{i}" for i, (c, n) in enumerate(gapfill.STAGES)) + f""" FROM p GROUP BY ALL),
fs AS (SELECT site, var, scenario, t, value, coalesce(value, {PICK(lambda i: f'a{i}')}) AS filled, {PICK(lambda i: f's{i}')} AS fsd, {PICK(lambda i: f'n{i}')} AS fnum, CAST(CASE WHEN value IS NOT NULL THEN 0 ELSE {PICK(lambda i: str(i + 1))} END AS INTEGER) AS stage, CAST(CASE WHEN value IS NOT NULL THEN 0 ELSE {CLASS} END AS INTEGER) AS fqc FROM v LEFT JOIN s USING (site, var, scenario, t))"""


def filled(spark, d):
    """nee in three scenarios, h and le; deviations of measured rows for nee and h only."""
    q = thresholds(spark, d).groupBy("site").agg(F.min("ustar").alias("U05"), F.percentile("ustar", F.lit(0.5)).alias("U50"), F.max("ustar").alias("U95"))
    own = wide(spark, d).withColumns({"vpd": F.col("rh") / 10, "ta": F.col("air")})
    return ustar.filled_scenarios(own, q, uncertain=("nee", "h"))


@query("us5_filled_scenarios", f"SELECT site, var, scenario, {T}, round(filled, 9) AS filled, round(fsd, 5) AS fsd, fnum, stage, fqc FROM fs", SERIES)
def us5_filled(spark, d):
    return filled(spark, d).select("site", "var", "scenario", text().alias("t"), F.round("filled", 9).alias("filled"), F.round("fsd", 5).alias("fsd"), "fnum", "stage", "fqc")


@query("gf4_uncertainty_by_series", "SELECT var, scenario, count(*) FILTER (value IS NOT NULL) AS measured, count(*) FILTER (value IS NOT NULL AND fsd IS NOT NULL) AS measured_with_fsd, count(*) FILTER (value IS NULL AND fsd IS NOT NULL) AS gaps_with_fsd FROM fs GROUP BY 1, 2", SERIES)
def gf4_by_series(spark, d):
    """Which deviations there are: of measured rows for nee and h, of gaps for all."""
    has = F.col("fsd").isNotNull()
    return filled(spark, d).groupBy("var", "scenario").agg(F.count("value").alias("measured"), F.count_if(F.col("value").isNotNull() & has).alias("measured_with_fsd"), F.count_if(F.col("value").isNull() & has).alias("gaps_with_fsd"))


@query("pr22_scenario_spread", f"SELECT site, {T}, round(fsdu, 6) AS fsdu, round(sqrt(fsd * fsd + fsdu * fsdu), 5) AS fsdug FROM (SELECT site, t, (max(filled) - min(filled)) / (2 * 1.96::DOUBLE) AS fsdu, max(fsd) FILTER (scenario = 'U50') AS fsd FROM fs WHERE var = 'nee' GROUP BY 1, 2)", SERIES)
def pr22_spread(spark, d):
    return ustar.scenario_spread(filled(spark, d)).select("site", text().alias("t"), F.round("fsdu", 6).alias("fsdu"), F.round("fsdug", 5).alias("fsdug"))


@query("us6_verify_theoretical_rg", "SELECT site, round(avg(CAST((swin < 10) = (rh * 6 < 10) AS INTEGER)), 8) AS same_night, 0.0 AS missing, round(avg(abs(swin - rh * 6)), 8) AS mean_gap, round(quantile_cont(abs(swin - rh * 6), 0.5), 8) AS median_gap FROM meteo GROUP BY 1")
def us6(spark, d):
    got = ustar.verify_theoretical_rg(meteo(spark, d).withColumn("theory", F.col("rh") * 6), "swin", "theory")
    return got.select("site", *(F.round(c, 8).alias(c) for c in ("same_night", "missing", "mean_gap", "median_gap")))


PT = f"""r0 AS (SELECT site, nee, air AS ta, date_diff('day', DATE '1970-01-01', CAST(t AS DATE)) AS day FROM wide WHERE swin < 10 AND nee IS NOT NULL AND air > {partition.T_ZERO + 1!r}),
r1 AS (SELECT site, nee, ta, unnest(generate_series(CAST(ceil((day - 14) / 5) AS BIGINT), CAST(floor(day / 5) AS BIGINT))) AS w FROM r0),
r2 AS (SELECT site, w, e0, nee, exp(e0 * (1.0::DOUBLE / {partition.T_REF - partition.T_ZERO!r}::DOUBLE - 1.0::DOUBLE / (ta - {partition.T_ZERO!r}::DOUBLE))) AS g FROM r1 CROSS JOIN (SELECT unnest(generate_series(30, 450, 5)) AS e0)),
r3 AS (SELECT site, w, e0, sum(nee * g) AS yg, sum(g * g) AS gg, sum(nee * nee) AS yy, count(*) AS n FROM r2 GROUP BY 1, 2, 3 HAVING count(*) >= 6),
r4 AS (SELECT site, w, e0, n, yg / gg AS rref, row_number() OVER (PARTITION BY site, w ORDER BY round(yy - yg * yg / gg, 6), e0) AS k FROM r3)"""


@query("pt1_partition_night", "SELECT site, strftime(DATE '1970-01-01' + CAST(w * 5 AS INTEGER), '%Y-%m-%d') AS start, CAST(e0 AS INTEGER) AS e0, round(rref, 6) AS rref, n FROM r4 WHERE k = 1", PT)
def pt1(spark, d):
    own = wide(spark, d).withColumn("ta", F.col("air"))
    return partition.partition_night(own).select("site", F.date_format("start", "yyyy-MM-dd").alias("start"), "e0", F.round("rref", 6).alias("rref"), "n")


@query("pt1_respiration", f"SELECT site, {T}, round(rref * exp(e0 * (1.0::DOUBLE / {partition.T_REF - partition.T_ZERO!r}::DOUBLE - 1.0::DOUBLE / (air - {partition.T_ZERO!r}::DOUBLE))), 6) AS reco FROM wide LEFT JOIN (SELECT * FROM r4 WHERE k = 1) f ON f.site = wide.site AND f.w = CAST(floor((date_diff('day', DATE '1970-01-01', CAST(t AS DATE)) - 7) / 5) AS BIGINT)".replace("SELECT site,", "SELECT wide.site,"), PT)
def pt1_reco(spark, d):
    own = wide(spark, d).withColumn("ta", F.col("air"))
    return partition.respiration(own, partition.partition_night(own)).select("site", text().alias("t"), F.round("reco", 6).alias("reco"))


@query("pt2_partition_day")
def pt2(spark, d):
    return partition.partition_day(wide(spark, d))


def carbon(spark, d):
    """Exchange as a respiration of known response and a light response make it, with the observed series as noise."""
    own = wide(spark, d).where("co2_flux is not null").withColumns({"ta": F.col("air"), "vpd": F.col("rh") / 5})
    nee = (3 + F.col("u_star")) * partition.temperature_response(F.col("air"), F.lit(200.0)) - 1.5 * F.col("swin") / (0.05 * F.col("swin") + 30) + F.col("co2_flux") / 50
    return own.select("site", "t", "ta", "vpd", "swin", nee.alias("nee"))


RESPONSE = lambda e0: f"exp({e0} * (1.0::DOUBLE / {partition.T_REF - partition.T_ZERO!r}::DOUBLE - 1.0::DOUBLE / (ta - {partition.T_ZERO!r}::DOUBLE)))"
OF_YEAR = "year(DATE '1970-01-01' + CAST(w * {} + {} AS INTEGER))"
REICHSTEIN = f"""c0 AS (SELECT site, t, air AS ta, swin, co2_flux FROM wide WHERE co2_flux IS NOT NULL AND air IS NOT NULL),
cb AS (SELECT c0.site, c0.t, c0.ta, c0.swin, (3 + u_star) * {RESPONSE(200)} - 1.5::DOUBLE * c0.swin / (0.05::DOUBLE * c0.swin + 30) + c0.co2_flux / 50 AS nee, date_diff('day', DATE '1970-01-01', CAST(c0.t AS DATE)) AS day, epoch(c0.t) AS sec FROM c0 JOIN (SELECT site, t, u_star FROM wide) USING (site, t)),
q0 AS (SELECT * FROM cb WHERE swin < 10 AND nee IS NOT NULL AND ta > {partition.T_ZERO + 1!r}),
q1 AS (SELECT site, nee, ta, unnest(generate_series(CAST(ceil((day - 14) / 5) AS BIGINT), CAST(floor(day / 5) AS BIGINT))) AS w FROM q0),
q2 AS (SELECT site, w, e0, nee, ta, {RESPONSE("e0")} AS g FROM q1 CROSS JOIN (SELECT unnest(generate_series(30, 450, 5)) AS e0)),
q3 AS (SELECT site, w, e0, sum(nee * nee) - sum(nee * g) * sum(nee * g) / sum(g * g) AS sse, count(*) AS n FROM q2 GROUP BY 1, 2, 3 HAVING count(*) >= 6 AND max(ta) - min(ta) >= 5),
q4 AS (SELECT *, lag(sse) OVER s AS b, lead(sse) OVER s AS a, row_number() OVER (PARTITION BY site, w ORDER BY round(sse, 9), e0) AS k FROM q3 WINDOW s AS (PARTITION BY site, w ORDER BY e0)),
q5 AS (SELECT site, w, e0 - 5 * (a - b) / (2 * (a + b - 2 * sse)) AS e0, sqrt(2 * greatest(sse, 0) / (n - 2) / ((a + b - 2 * sse) / 25)) AS se, n FROM q4 WHERE k = 1 AND a IS NOT NULL AND b IS NOT NULL AND a + b - 2 * sse > 0 AND n > 2),
q6 AS (SELECT * FROM q5 WHERE se <= 0.5 * e0),
q7 AS (SELECT site, year, avg(e0) AS e0 FROM (SELECT *, row_number() OVER (PARTITION BY site, year ORDER BY se, w) AS k FROM (SELECT *, {OF_YEAR.format(5, 7)} AS year FROM q6)) WHERE k <= 3 GROUP BY 1, 2),
q8 AS (SELECT site, sec, nee, ta, w, {OF_YEAR.format(4, 3)} AS year FROM (SELECT site, sec, nee, ta, unnest(generate_series(CAST(ceil((day - 6) / 4) AS BIGINT), CAST(floor(day / 4) AS BIGINT))) AS w FROM q0)),
q9 AS (SELECT site, avg(sec) AS at, e0, sum(nee * {RESPONSE("e0")}) / sum({RESPONSE("e0")} * {RESPONSE("e0")}) AS rref, count(*) AS n FROM q8 JOIN q7 USING (site, year) GROUP BY site, w, e0),
qm AS (SELECT * FROM q9 WHERE n >= 6 AND rref > 0)"""


@query("pt1_night_sensitivity", "SELECT site, CAST(w AS INTEGER) AS w, round(e0, 3) AS e0, round(se, 3) AS se, n FROM q6", REICHSTEIN)
def pt1_windows(spark, d):
    return partition.night_sensitivity(carbon(spark, d)).select("site", "w", F.round("e0", 3).alias("e0"), F.round("se", 3).alias("se"), "n")


@query("pt1_site_sensitivity", "SELECT site, CAST(year AS INTEGER) AS year, round(e0, 3) AS e0 FROM q7", REICHSTEIN)
def pt1_site(spark, d):
    return partition.site_sensitivity(partition.night_sensitivity(carbon(spark, d))).select("site", "year", F.round("e0", 3).alias("e0"))


@query("pt1_night_fluxes", f"""SELECT cb.site, {T.replace('t,', 'cb.t,')}, round(r * {RESPONSE('e').replace('(ta', '(cb.ta')}, 5) AS reco, round(r * {RESPONSE('e').replace('(ta', '(cb.ta')} - nee, 5) AS gpp FROM (
  SELECT cb.*, coalesce(x.rref + (y.rref - x.rref) * ((sec - x.at) / (y.at - x.at)), x.rref, y.rref) AS r, coalesce(x.e0, y.e0) AS e FROM cb ASOF LEFT JOIN qm x ON x.site = cb.site AND x.at <= cb.sec ASOF LEFT JOIN qm y ON y.site = cb.site AND y.at > cb.sec) cb""", REICHSTEIN)
def pt1_fluxes(spark, d):
    own = carbon(spark, d)
    e0 = partition.site_sensitivity(partition.night_sensitivity(own))
    got = partition.night_fluxes(own, partition.night_reference(own, e0))
    return got.select("site", text().alias("t"), F.round("reco", 5).alias("reco"), F.round("gpp", 5).alias("gpp"))


def responses(spark, d):
    own = carbon(spark, d)
    return partition.light_responses(own, partition.night_sensitivity(own, days=12, every=2))


@query("pt2_light_responses")
def pt2_responses(spark, d):
    return responses(spark, d)


@query("pt2_day_fluxes")
def pt2_fluxes(spark, d):
    return partition.day_fluxes(carbon(spark, d), responses(spark, d)).select("site", text().alias("t"), "reco_dt", "gpp_dt")


PLACES = "places AS (SELECT 'S' || s_suppkey AS site, 40.0::DOUBLE + 5 * s_suppkey AS lat, 15.0::DOUBLE * s_suppkey - 20 AS lon, CAST(s_suppkey AS DOUBLE) AS tz FROM supplier)"
ELEVATION = f"(sin({DECL}) * sin(radians(lat)) + cos({DECL}) * cos(radians(lat)) * cos((hour(t) + minute(t) / 60 + (lon / 15 - tz) + {EQ} - 12) * {math.pi!r}::DOUBLE / 12))"


@query("pt3_location", f"SELECT site, {T}, round(CASE WHEN {ELEVATION} > 0 THEN 1366.1::DOUBLE * (1 + 0.034 * cos({Y})) * {ELEVATION} ELSE 0 END, 5) AS rg_pot, {ELEVATION} <= 0 AS night FROM meteo JOIN places USING (site)", PLACES)
def pt3(spark, d):
    """The table of stations gives each row its place, which the radiation and what counts as night follow."""
    n = F.col("s_suppkey")
    places = table(spark, d, "supplier").select(F.concat(F.lit("S"), n.cast("string")).alias("site"), (40.0 + 5 * n).alias("lat"), (15.0 * n - 20).alias("lon"), n.cast("double").alias("tz"))
    own = meteo(spark, d).join(places, "site")
    at = (F.dayofyear("t"), F.hour("t") + F.minute("t") / 60, F.col("lat"), F.col("lon"), F.col("tz"))
    return own.select("site", text().alias("t"), F.round(derive.potential_radiation(*at), 5).alias("rg_pot"), (derive.solar_elevation_sine(*at) <= 0).alias("night"))
