"""Queries of the time grid, windows, gap filling and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import filters, gapfill, tables, timegrid
from .stations import T, gridded, meteo, obs, query, table, text, wide

KEY = f"site, var, {T}"


def key(df, *columns):
    return df.select("site", "var", text().alias("t"), *columns)


@query("ts1_infer_step", "SELECT site, min(step) AS step FROM (SELECT site, first(lo ORDER BY b) FILTER (n = 5 AND lo = hi) AS step FROM (SELECT site, (rn - 3) // 5 AS b, count(*) AS n, min(d) AS lo, max(d) AS hi FROM (SELECT site, row_number() OVER w AS rn, CAST(epoch(t) - epoch(lag(t) OVER w) AS BIGINT) AS d FROM meteo WINDOW w AS (PARTITION BY site ORDER BY t)) WHERE rn BETWEEN 3 AND 100 GROUP BY 1, 2) GROUP BY site) GROUP BY site")
def ts1(spark, d):
    return timegrid.infer_step(meteo(spark, d))


@query("ts2_repair_time", f"SELECT {KEY}, value FROM gridv")
def ts2(spark, d):
    return key(timegrid.repair_time(obs(spark, d), "30 MINUTES", ("site", "var")), "value")


@query("ts2_off_grid", "SELECT site, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t FROM (SELECT DISTINCT 'S' || (user_id % 4) AS site, ts FROM events) JOIN (SELECT 'S' || (user_id % 4) AS site, min(ts) AS lo FROM events GROUP BY 1) USING (site) WHERE (epoch_us(ts) // 1000000 - epoch_us(lo) // 1000000) % 60 <> 0")
def ts2_off(spark, d):
    own = table(spark, d, "events").select(F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("site"), F.col("ts").alias("t"))
    return timegrid.off_grid(own, 60).select("site", F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"))


def disturbed(spark, d):
    """The series with stamps off the grid: one, the first, of each `le`, and all of three hours of each `h`; nulls for a hundredth of `ta`; every seventh of `nee` twice."""
    own = obs(spark, d).withColumn("lo", F.min("t").over(Window.partitionBy("site", "var")))
    stray = (F.col("var") == "le") & (F.col("t") == F.col("lo")) | (F.col("var") == "h") & (F.hour("t") < 3)
    t = F.when(stray, F.expr("t + INTERVAL 7 MINUTES")).when((F.col("var") != "ta") | (F.dayofmonth("t") != 3), F.col("t"))
    own = own.withColumn("t", t).withColumn("line", F.when((F.col("var") == "nee") & (F.col("qc") == 2), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return own.select("site", "var", "t", "value", F.explode("line").alias("line"))


DISTURBED = """x AS (SELECT site, var, CASE WHEN (var = 'le' AND t = min(t) OVER (PARTITION BY site, var)) OR (var = 'h' AND hour(t) < 3) THEN t + INTERVAL 7 MINUTE WHEN var <> 'ta' OR day(t) <> 3 THEN t END AS t, value, unnest(CASE WHEN var = 'nee' AND qc = 2 THEN [0, 1] ELSE [0] END) AS line FROM obs),
y AS (SELECT site, var, t, epoch_us(t) % 1800000000 AS p, count(*) AS n FROM x GROUP BY 1, 2, 3),
z AS (SELECT site, var, p, count(t) AS k, sum(n) AS n FROM y GROUP BY 1, 2, 3),
vd AS (SELECT *, CASE WHEN rows - missing < 12 THEN 'short' WHEN off_grid > 1 THEN 'irregular' WHEN off_grid + duplicates + missing > 0 THEN 'repaired' ELSE 'ok' END AS verdict FROM (
  SELECT site, var, CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (p IS NULL), 0) AS BIGINT) AS missing, CAST(coalesce(sum(n - k) FILTER (p IS NOT NULL), 0) AS BIGINT) AS duplicates, first(p ORDER BY k DESC, p) FILTER (p IS NOT NULL) AS phase, CAST(sum(k) - coalesce(max(k), 0) AS BIGINT) AS off_grid FROM z GROUP BY 1, 2))"""


@query("ts2_series_verdicts", "SELECT * FROM vd", DISTURBED)
def ts2_verdicts(spark, d):
    return timegrid.series_verdicts(disturbed(spark, d), 1800, ("site", "var"))


@query("ts2_strict_repair", """SELECT g.site, g.var, strftime(g.t, '%Y-%m-%d %H:%M:%S') AS t, o.value FROM (SELECT site, var, unnest(generate_series(min(t), max(t), INTERVAL 30 MINUTE)) AS t FROM w GROUP BY 1, 2) g
  LEFT JOIN (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY site, var, t ORDER BY line) = 1) o USING (site, var, t)""", DISTURBED + ", w AS (SELECT x.* FROM x JOIN vd USING (site, var) WHERE verdict IN ('ok', 'repaired') AND epoch_us(t) % 1800000000 = phase)")
def ts2_strict(spark, d):
    """Series that can't be repaired are left out here; ts2_series_verdicts lists them."""
    got, _ = timegrid.strict_repair(disturbed(spark, d), 1800, ("site", "var"), ("line",), fail=False)
    return key(got, "value")


@query("ts3_parse_stamps", "SELECT file, n, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM (SELECT event_type AS file, event_id AS n, date_trunc('minute', ts) AS ts FROM events)")
def ts3(spark, d):
    """Each event type writes stamps in its own format."""
    fmt = ["yyyy-M-d H:mm", "d.M.yyyy H:mm", "d/M/yyyy H:mm"]
    i = F.pmod(F.length("event_type"), F.lit(3))
    raw = F.when(i == 0, F.date_format("ts", fmt[0])).when(i == 1, F.date_format("ts", fmt[1])).otherwise(F.date_format("ts", fmt[2]))
    own = table(spark, d, "events").select(F.col("event_type").alias("file"), F.col("event_id").alias("n"), raw.alias("stamp"))
    return timegrid.parse_stamps(own, "stamp", fmt, "file").select("file", "n", text().alias("t"))


@query("ts4_union_by_time", f"SELECT {KEY}, value FROM (SELECT *, row_number() OVER (PARTITION BY site, var, t ORDER BY source) AS r FROM (SELECT site, var, t, value, 0 AS source FROM obs WHERE qc < 2 UNION ALL SELECT site, var, t, value + 1, 1 FROM obs)) WHERE r = 1")
def ts4(spark, d):
    own = obs(spark, d)
    both = timegrid.union_by_time(own.where("qc < 2").select("site", "var", "t", "value"), own.select("site", "var", "t", (F.col("value") + 1).alias("value")))
    return key(timegrid.keep_first(both, ["site", "var", "t"], [F.col("source")]), "value")


@query("ts5_asfreq", f"SELECT site, {T}, rh FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL '1 hour')) AS t FROM meteo GROUP BY site) LEFT JOIN meteo USING (site, t)")
def ts5(spark, d):
    own = meteo(spark, d)
    spans = own.groupBy("site").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    return timegrid.grid(spans, "1 HOUR", ["site"]).join(own.select("site", "t", "rh"), ["site", "t"], "left").select("site", text().alias("t"), "rh")


FLUX = "f AS (SELECT site, t, co2_flux, ta FROM wide WHERE co2_flux IS NOT NULL), m AS (SELECT site, t, air AS ta, rh FROM meteo WHERE co2_signal_strength > 40)"


@query("ts6_outer_join_meteo", f"SELECT site, {T}, co2_flux, f.ta AS ta, m.ta AS ta_meteo, rh FROM f FULL OUTER JOIN m USING (site, t)", FLUX)
def ts6(spark, d):
    own = wide(spark, d).where("co2_flux is not null").select("site", "t", "co2_flux", "ta")
    met = meteo(spark, d).where("co2_signal_strength > 40").select("site", "t", F.col("air").alias("ta"), "rh")
    return timegrid.outer_join_meteo(own, met).select("site", text().alias("t"), "co2_flux", "ta", "ta_meteo", "rh")


@query("ts6_has_meteo", "SELECT site, count(x) > 0 AS has_meteo FROM (SELECT site, m.rh AS x FROM f FULL OUTER JOIN (SELECT * FROM m WHERE site <> 'S2') m USING (site, t)) GROUP BY 1", FLUX)
def ts6_has(spark, d):
    """One site's weather is missing."""
    own = wide(spark, d).where("co2_flux is not null").select("site", "t", "co2_flux", "ta")
    met = meteo(spark, d).where("co2_signal_strength > 40 and site <> 'S2'").select("site", "t", F.col("air").alias("ta"), "rh")
    return timegrid.has_meteo(timegrid.outer_join_meteo(own, met), "rh")


@query("ts6_outer_join_meteo_wins", f"SELECT site, {T}, co2_flux, m.ta AS ta, rh FROM f FULL OUTER JOIN m USING (site, t)", FLUX)
def ts6b(spark, d):
    own = wide(spark, d).where("co2_flux is not null").select("site", "t", "co2_flux", "ta")
    met = meteo(spark, d).where("co2_signal_strength > 40").select("site", "t", F.col("air").alias("ta"), "rh")
    return timegrid.outer_join_meteo(own, met, None).select("site", text().alias("t"), "co2_flux", "ta", "rh")


ORDERS = "o AS (SELECT 'C' || (o_custkey % 3) AS site, o_orderdate AS t, count(*) AS n FROM orders GROUP BY 1, 2)"


def days(spark, d):
    return table(spark, d, "orders").groupBy(F.concat(F.lit("C"), (F.col("o_custkey") % 3).cast("string")).alias("site"), F.col("o_orderdate").alias("t")).agg(F.count("*").alias("n"))


@query("ts7_snap_intervals", "SELECT g.site AS site, strftime(g.t, '%Y-%m-%d') AS t, o.n AS n FROM (SELECT site, unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t FROM (SELECT site, min(u) AS lo, max(u) + INTERVAL 1 MONTH AS hi FROM (SELECT site, date_trunc('month', t) AS u, count(*) AS n, min(date_trunc('month', t)) AS _ FROM o GROUP BY 1, 2) x WHERE n >= 5 OR (u > (SELECT min(date_trunc('month', t)) FROM o y WHERE y.site = x.site) AND u < (SELECT max(date_trunc('month', t)) FROM o y WHERE y.site = x.site)) GROUP BY site)) g LEFT JOIN o ON o.site = g.site AND o.t = g.t", ORDERS)
def ts7(spark, d):
    return timegrid.snap_interval(days(spark, d), "month", 5, "1 DAY").select("site", F.date_format("t", "yyyy-MM-dd").alias("t"), "n")


@query("ts9_split_by_interval", "SELECT site, year(t) AS year, month(t) AS month, count(*) AS rows FROM o GROUP BY 1, 2, 3 HAVING count(*) >= 5", ORDERS)
def ts9(spark, d):
    own = days(spark, d).groupBy("site", F.year("t").alias("year"), F.month("t").alias("month")).agg(F.count("*").alias("rows"))
    return own.where("rows >= 5")


@query("ts10_interval_labels", "SELECT site, strftime(t, '%Y%m%d%H%M') AS timestamp_start, strftime(t + INTERVAL 30 MINUTE, '%Y%m%d%H%M') AS timestamp_end, round(dayofyear(t + INTERVAL 30 MINUTE) + (hour(t + INTERVAL 30 MINUTE) * 60 + minute(t + INTERVAL 30 MINUTE)) / 1440, 3) AS dtime FROM meteo")
def ts10(spark, d):
    return meteo(spark, d).select("site", *(c.alias(n) for n, c in timegrid.interval_labels().items()))


@query("ts11_season_labels", "SELECT site, strftime(t, '%Y-%m-%d') AS t, (year(t) + CASE WHEN month(t) = 12 THEN 1 ELSE 0 END) || '-' || CASE WHEN month(t) IN (12, 1, 2) THEN '12' ELSE lpad(CAST(month(t) // 3 * 3 AS VARCHAR), 2, '0') END AS continuous, year(t) || '-' || CASE WHEN month(t) IN (12, 1, 2) THEN '12' ELSE lpad(CAST(month(t) // 3 * 3 AS VARCHAR), 2, '0') END AS within_year FROM o", ORDERS)
def ts11(spark, d):
    return days(spark, d).select("site", F.date_format("t", "yyyy-MM-dd").alias("t"), timegrid.season().alias("continuous"), timegrid.season("within_year").alias("within_year"))


FULL_YEAR = "g AS (SELECT site, unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-31', INTERVAL 1 DAY)) AS t FROM (SELECT DISTINCT site FROM o))"


@query("ts12_grid_missing_extra", "SELECT site, strftime(t, '%Y-%m-%d') AS t, 'missing' AS problem FROM (SELECT site, t FROM g EXCEPT SELECT site, t FROM o) UNION ALL SELECT site, strftime(t, '%Y-%m-%d'), 'extra' FROM (SELECT site, t FROM o EXCEPT SELECT site, t FROM g)", ORDERS + ", " + FULL_YEAR)
def ts12(spark, d):
    return timegrid.missing_extra(days(spark, d), "1996-01-01", "1996-12-31", "1 DAY").select("site", F.date_format("t", "yyyy-MM-dd").alias("t"), "problem")


@query("dq4_full_year_check", "SELECT site, problem, count(*) AS n FROM (SELECT site, t, 'missing' AS problem FROM (SELECT site, t FROM g EXCEPT SELECT site, t FROM o) UNION ALL SELECT site, t, 'extra' FROM (SELECT site, t FROM o EXCEPT SELECT site, t FROM g)) GROUP BY 1, 2", ORDERS + ", " + FULL_YEAR)
def dq4(spark, d):
    return timegrid.missing_extra(days(spark, d), "1996-01-01", "1996-12-31", "1 DAY").groupBy("site", "problem").agg(F.count("*").alias("n"))


@query("so1_index_intersection", f"SELECT {KEY}, value FROM obs WHERE (site, t) IN (SELECT site, t FROM meteo WHERE rh > 60)")
def so1(spark, d):
    return key(obs(spark, d).join(meteo(spark, d).where("rh > 60"), ["site", "t"], "left_semi"), "value")


@query("so2_index_difference", f"SELECT {KEY}, value FROM obs WHERE (site, t) NOT IN (SELECT site, t FROM meteo WHERE rh > 60)")
def so2(spark, d):
    return key(obs(spark, d).join(meteo(spark, d).where("rh > 60"), ["site", "t"], "left_anti"), "value")


@query("so3_distinct_keep_first", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def so3(spark, d):
    return timegrid.keep_first(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id")


@query("so4_column_bind", f"SELECT site, {T}, co2_flux, rh FROM wide")
def so4(spark, d):
    return wide(spark, d).select("site", "t", "co2_flux").join(meteo(spark, d).select("site", "t", "rh"), ["site", "t"]).select("site", text().alias("t"), "co2_flux", "rh")


@query("sl1_sort_calendar", "SELECT site, year(t) AS year, month(t) AS month, day(t) AS dom, count(*) AS n FROM obs GROUP BY 1, 2, 3, 4 ORDER BY 1, 2, 3, 4")
def sl1(spark, d):
    return obs(spark, d).groupBy("site", F.year("t").alias("year"), F.month("t").alias("month"), F.dayofmonth("t").alias("dom")).agg(F.count("*").alias("n")).orderBy("site", "year", "month", "dom")


@query("sl2_head_per_site", f"SELECT site, {T}, rh FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY t) AS r FROM meteo) WHERE r <= 144")
def sl2(spark, d):
    return timegrid.head_per_site(meteo(spark, d), 144).select("site", text().alias("t"), "rh")


@query("sl3_skip_to_first_half_hour", f"SELECT site, {T}, rh FROM (SELECT *, min(CASE WHEN hour(t) = 0 AND minute(t) = 30 THEN t END) OVER (PARTITION BY site) AS f FROM meteo) WHERE t >= f")
def sl3(spark, d):
    return timegrid.skip_to_first_half_hour(meteo(spark, d)).select("site", text().alias("t"), "rh")


@query("sl4_time_range", "SELECT site, var, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last, count(*) AS n FROM obs GROUP BY 1, 2")
def sl4(spark, d):
    return timegrid.time_range(obs(spark, d), ["site", "var"]).select("site", "var", text("first").alias("first"), text("last").alias("last"), "n")


ROLL = "CASE WHEN count(value) OVER w >= 4 THEN round(avg(value) OVER w, 8) END"


@query("ts8_rolling_diurnal_mean", f"SELECT {KEY}, {ROLL} AS mean FROM gridv WINDOW w AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)")
def ts8(spark, d):
    return key(gridded(spark, d).withColumn("mean", F.round(filters.diurnal_mean(F.col("value"), 10, 4), 8)), "mean")


@query("pr21_residual", f"SELECT {KEY}, round(CASE WHEN count(value) OVER w >= 4 THEN avg(value) OVER w END - value, 8) AS residual FROM gridv WINDOW w AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)")
def pr21(spark, d):
    own = gridded(spark, d).withColumn("m", filters.diurnal_mean(F.col("value"), 10, 4))
    return key(own, F.round(F.col("m") - F.col("value"), 8).alias("residual"))


INTERP = """i0 AS (SELECT *, row_number() OVER (PARTITION BY site, var ORDER BY t) AS n FROM gridv),
i1 AS (SELECT *, last_value(value IGNORE NULLS) OVER p AS a, last_value(CASE WHEN value IS NOT NULL THEN n END IGNORE NULLS) OVER p AS i, first_value(value IGNORE NULLS) OVER f AS b, first_value(CASE WHEN value IS NOT NULL THEN n END IGNORE NULLS) OVER f AS j FROM i0
  WINDOW p AS (PARTITION BY site, var ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY site, var ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
i2 AS (SELECT *, coalesce(value, CASE WHEN n - i <= 3 THEN coalesce(a + (b - a) * ((n - i) / (j - i)), a) END) AS filled FROM i1)"""


@query("gf1_interpolate_limit", f"SELECT {KEY}, round(filled, 8) AS filled FROM i2", INTERP)
def gf1(spark, d):
    return key(gapfill.interpolate_limit(gridded(spark, d)), F.round("filled", 8).alias("filled"))


@query("gf2_fill_diurnal", f"SELECT {KEY}, round(coalesce(filled, CASE WHEN count(value) OVER w >= 4 THEN avg(value) OVER w END, -99999), 8) AS filled FROM i2 WINDOW w AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)", INTERP)
def gf2(spark, d):
    return key(gapfill.fill_diurnal(gridded(spark, d)), F.round("filled", 8).alias("filled"))


def series(spark, d):
    """co2_flux of each site on the grid of its drivers, with vapour pressure deficit and temperature."""
    own = wide(spark, d).select("site", "t", F.col("co2_flux").alias("value"), F.col("swin").alias("rg"), (F.col("rh") / 10).alias("vpd"), F.col("air").alias("ta"))
    return own


N = len(gapfill.STAGES)
SIMILAR = {"all": "na", "rg": "nr", "": "nm"}
MDS = """v AS (SELECT site, t, co2_flux AS value, swin AS rg, rh / 10 AS vpd, air AS ta, CAST(t AS DATE) AS day, hour(t) * 60 + minute(t) AS minute FROM wide),
p AS (SELECT g.site, g.t, h.value, abs(date_diff('day', g.day, h.day)) AS off, abs(g.rg - h.rg) < 50 AS nr, abs(g.rg - h.rg) < 50 AND abs(g.vpd - h.vpd) < 5 AND abs(g.ta - h.ta) < 2.5 AS na, abs(g.minute - h.minute) <= 60 AS nm
  FROM v g JOIN v h ON g.site = h.site AND h.day BETWEEN g.day - 28 AND g.day + 28 WHERE g.value IS NULL AND h.value IS NOT NULL),
s AS (SELECT site, t, """ + ", ".join(f"count(*) FILTER ({SIMILAR[c]} AND off <= {n}) AS n{i}, avg(value) FILTER ({SIMILAR[c]} AND off <= {n}) AS a{i}, stddev_samp(value) FILTER ({SIMILAR[c]} AND off <= {n}) AS s{i}" for i, (c, n) in enumerate(gapfill.STAGES)) + " FROM p GROUP BY site, t)"
PICK = lambda c: "CASE " + " ".join(f"WHEN n{i} >= 2 THEN {c(i)}" for i in range(N)) + " END"
CLASS = PICK(lambda i: str(gapfill.quality_class(*gapfill.STAGES[i])))


@query("gf3_mds_gap_fill", f"SELECT site, {T}, round(coalesce(value, {PICK(lambda i: f'a{i}')}), 9) AS filled, round({PICK(lambda i: f's{i}')}, 9) AS fsd, CAST(CASE WHEN value IS NOT NULL THEN 0 ELSE {PICK(lambda i: str(i + 1))} END AS INTEGER) AS stage, CAST(CASE WHEN value IS NOT NULL THEN 0 ELSE {CLASS} END AS INTEGER) AS fqc FROM v LEFT JOIN s USING (site, t)", MDS)
def gf3(spark, d):
    got = gapfill.mds_gap_fill(series(spark, d))
    return got.select("site", text().alias("t"), F.round("filled", 9).alias("filled"), F.round("fsd", 9).alias("fsd"), "stage", "fqc")


@query("gf4_skip_uncertainty", f"SELECT site, fqc, count(*) AS n FROM (SELECT site, CASE WHEN value IS NOT NULL THEN 0 ELSE {CLASS} END AS fqc FROM v LEFT JOIN s USING (site, t)) GROUP BY 1, 2", MDS)
def gf4(spark, d):
    got = gapfill.mds_gap_fill(series(spark, d)).withColumn("fsd", gapfill.keep_uncertainty(F.col("fsd"), F.lit(False)))
    return got.groupBy("site", "fqc").agg((F.count("*") + F.count("fsd")).alias("n"))


@query("cl4_filter_long_runs", f"SELECT {KEY}, CASE WHEN count(*) OVER (PARTITION BY site, var, run) < 3 THEN value END AS value FROM (SELECT *, sum(new) OVER (PARTITION BY site, var ORDER BY t) AS run FROM (SELECT site, var, t, CAST(floor(value) AS DOUBLE) AS value, CASE WHEN floor(value) IS NOT DISTINCT FROM lag(floor(value)) OVER (PARTITION BY site, var ORDER BY t) THEN 0 ELSE 1 END AS new FROM obs))")
def cl4(spark, d):
    own = obs(spark, d).withColumn("value", F.floor("value").cast("double"))
    return key(tables.filter_long_runs(own, 3), F.col("value_runs").alias("value"))


@query("pr16_albedo", f"SELECT site, {T}, CASE WHEN a < q THEN round(a, 8) END AS albedo FROM (SELECT *, quantile_cont(a, 0.95) OVER (PARTITION BY site) AS q FROM (SELECT site, t, CASE WHEN swin > 20 AND rh > 0 THEN rh / swin END AS a FROM meteo))")
def pr16(spark, d):
    from ..operators import derive

    own = meteo(spark, d).withColumn("albedo", derive.albedo(F.col("swin"), F.col("rh")))
    return derive.albedo_below_quantile(own).select("site", text().alias("t"), F.round("albedo", 8).alias("albedo"))


@query("grid_step_check", "SELECT site, var, count(*) AS steps, CAST(min(d) AS BIGINT) AS lo, CAST(max(d) AS BIGINT) AS hi FROM (SELECT site, var, epoch(t) - epoch(lag(t) OVER (PARTITION BY site, var ORDER BY t)) AS d FROM gridv) WHERE d IS NOT NULL GROUP BY 1, 2")
def step_check(spark, d):
    """Frames of other operators rely on it: every step of a repaired series is the same."""
    order = Window.partitionBy("site", "var").orderBy("t")
    own = gridded(spark, d).withColumn("d", F.unix_seconds(F.col("t").cast("timestamp")) - F.unix_seconds(F.lag("t").over(order).cast("timestamp")))
    return own.where("d is not null").groupBy("site", "var").agg(F.count("*").alias("steps"), F.min("d").alias("lo"), F.max("d").alias("hi"))
