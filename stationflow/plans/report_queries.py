"""Queries of calendar aggregates, reports, checks, readers and export tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..operators import calendar, derive, filters, tables, timegrid
from ..sources import sinks, station_files
from .filter_queries import CHAIN, FLAGS, chain
from .grid_queries import INTERP, ORDERS, days
from .stations import T, gridded, meteo, obs, query, table, text, wide

PAIRS = "lineitem_t AS (SELECT 'L' || (l_suppkey % 3) AS site, l_shipdate + to_hours(CAST(l_linenumber AS INTEGER)) AS t, CAST(l_quantity AS BIGINT) AS q, CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_quantity AS BIGINT) END AS raw FROM lineitem)"


def shipments(spark, d):
    """Multi-year series: a filled value, and the raw one with gaps."""
    q = F.col("l_quantity").cast("long")
    t = F.expr("l_shipdate + make_dt_interval(0, cast(l_linenumber as int))")
    return table(spark, d, "lineitem").select(F.concat(F.lit("L"), (F.col("l_suppkey") % 3).cast("string")).alias("site"), t.alias("t"), q.alias("q"), F.when(F.col("l_orderkey") % 3 != 0, q).alias("raw"))


MEANS = """SELECT site, CASE WHEN h IS NOT NULL THEN 'hourly' WHEN dom IS NOT NULL THEN 'daily' WHEN month IS NOT NULL THEN 'monthly' ELSE 'yearly' END AS level, year, month, dom, doy, h AS hour, q, q_sqc FROM (
SELECT site, year, month, dom, doy, h, {mean} AS q, round(count(raw) / count(*), 8) AS q_sqc FROM (SELECT *, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS dom, CAST(dayofyear(t) AS INTEGER) AS doy, hour(t) + minute(t) / 60 AS h FROM lineitem_t)
GROUP BY GROUPING SETS ((site, year, month, h), (site, year, month, dom, doy), (site, year, month), (site, year)))"""


def means(spark, d, threshold=None):
    got = calendar.calendar_means(shipments(spark, d), {"q": "raw"}, threshold)
    return got.select("site", "level", "year", "month", "dom", "doy", "hour", F.round("q", 8).alias("q"), F.round("q_sqc", 8).alias("q_sqc"))


@query("ag1_calendar_means", MEANS.format(mean="round(avg(q), 8)"), PAIRS)
def ag1(spark, d):
    return means(spark, d)


@query("ag2_completeness_ratio", "SELECT site, CAST(year(t) AS INTEGER) AS year, round(count(raw) / count(*), 8) AS q_sqc FROM lineitem_t GROUP BY 1, 2", PAIRS)
def ag2(spark, d):
    return means(spark, d).where("level = 'yearly'").select("site", "year", "q_sqc")


@query("ag3_mean_with_threshold", MEANS.format(mean="CASE WHEN count(raw) / count(*) > 0.66 THEN round(avg(q), 8) END"), PAIRS)
def ag3(spark, d):
    return means(spark, d, 0.66)


@query("ag4_pair_columns", "SELECT site, round(avg(co2_flux), 8) AS co2_flux_f, round(avg(h), 8) AS h_f FROM wide GROUP BY 1")
def ag4(spark, d):
    own = wide(spark, d).withColumns({"co2_flux_f": F.col("co2_flux"), "h_f": F.col("h"), "h_ff": F.lit(1)})
    return own.groupBy("site").agg(*(F.round(F.avg(c), 8).alias(c) for c in calendar.pair_columns(own.columns)))


@query("ag1_calendar_aggregates", MEANS.format(mean="min(q)").replace(" AS q,", " AS q_lo, max(q) AS q_hi, count(q) AS q_n, CASE WHEN count(q) > 1 THEN round(stddev_samp(q), 8) END AS q_std,").replace("AS hour, q, q_sqc", "AS hour, q_lo, q_hi, q_n, q_std, q_sqc"), PAIRS)
def ag1_aggregates(spark, d):
    """Other functions than the mean, in the same pass."""
    got = calendar.calendar_means(shipments(spark, d), {"q": "raw"}, aggregates={"lo": F.min, "hi": F.max, "n": F.count, "std": lambda c: F.round(F.stddev_samp(c), 8)})
    return got.withColumn("q_sqc", F.round("q_sqc", 8)).select("site", "level", "year", "month", "dom", "doy", "hour", "q_lo", "q_hi", "q_n", "q_std", "q_sqc")


@query("ag5_trim_short_years", "SELECT site, strftime(t, '%Y-%m-%d') AS t, n FROM (SELECT *, (lag(t) OVER w IS NULL AND lead(year(t)) OVER w <> year(t)) OR (lead(t) OVER w IS NULL AND lag(year(t)) OVER w <> year(t)) AS x FROM (SELECT 'R' || (o_custkey % 97) AS site, CAST(o_orderdate AS TIMESTAMP) AS t, count(*) AS n FROM orders GROUP BY 1, 2) WINDOW w AS (PARTITION BY site ORDER BY t)) WHERE NOT coalesce(x, false)")
def ag5(spark, d):
    """Customers in 97 groups: with so few days to a group, some years hold a single one."""
    own = table(spark, d, "orders").groupBy(F.concat(F.lit("R"), (F.col("o_custkey") % 97).cast("string")).alias("site"), F.col("o_orderdate").cast("timestamp_ntz").alias("t")).agg(F.count("*").alias("n"))
    return calendar.trim_short_years(own).select("site", F.date_format("t", "yyyy-MM-dd").alias("t"), "n")


@query("ag7_describe", "SELECT site, var, count(value) AS n, round(avg(value), 8) AS mean, round(stddev_samp(value), 8) AS std, min(value) AS lo, round(quantile_cont(value, 0.25), 8) AS q25, round(quantile_cont(value, 0.5), 8) AS q50, round(quantile_cont(value, 0.75), 8) AS q75, max(value) AS hi FROM obs GROUP BY 1, 2")
def ag7(spark, d):
    return calendar.describe(obs(spark, d)).select("site", "var", "n", "lo", "hi", *(F.round(c, 8).alias(c) for c in ("mean", "std", "q25", "q50", "q75")))


SUMMARY = CHAIN + ", k AS (SELECT *, CASE WHEN f_quantile = 1 THEN value END AS kept FROM c3)"
MEAN = "round(coalesce(CASE WHEN count(kept) OVER {w} >= 7 THEN avg(kept) OVER {w} END, -9999), 8)"


@query("ag8_summary_table", f"SELECT site, strftime(t, '%Y-%m-%d') AS date, strftime(t, '%H:%M') AS time, CAST(dayofyear(t) AS INTEGER) AS doy, var, coalesce(value, -9999) AS raw, coalesce(kept, -9999) AS filtered, CAST(f_quantile AS INTEGER) AS flag, {MEAN.format(w='a')} AS mean_10, {MEAN.format(w='b')} AS mean_30 FROM k WINDOW a AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING), b AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)", SUMMARY)
def ag8(spark, d):
    return sinks.summary(filters.collapse_flags(chain(spark, d), FLAGS))


@query("snk5_write_summary", "SELECT site, var, count(*) AS rows, count(*) FILTER (kept IS NULL) AS coded FROM k GROUP BY 1, 2", SUMMARY)
def snk5(spark, d):
    """Counted in the files as they come back."""
    back = exported(sinks.summary(filters.collapse_flags(chain(spark, d), FLAGS)), ["site"])
    return back.groupBy("site", "var").agg(F.count("*").alias("rows"), F.count_if(F.col("filtered") == -9999).alias("coded"))


@query("ag8_summary_variables", f"SELECT site, regexp_replace(var, '^(ta|rh|vpd|swin|ppfd|p)(_[1-9])+$', '\\1') AS var, CASE WHEN var LIKE 'ppfd%' THEN 'rg' ELSE regexp_replace(var, '^(ta|rh|vpd|swin|ppfd|p)(_[1-9])+$', '\\1') END AS mean_name, {T}, value FROM ix WHERE var NOT IN (SELECT var FROM ix i WHERE i.site = ix.site AND i.var = 'ta_2_1_1' AND EXISTS (SELECT 1 FROM ix j WHERE j.site = i.site AND j.var = 'ta_1_1_1'))", "ix AS (SELECT site, t, value, CASE WHEN var = 'ta' THEN CASE WHEN hour(t) < 12 AND site <> 'S1' THEN 'ta_1_1_1' ELSE 'ta_2_1_1' END WHEN var = 'h' THEN 'ppfd_1_1_1' WHEN var = 'p_rain' THEN 'p_3' ELSE var END AS var FROM obs)")
def ag8_variables(spark, d):
    """Sites with two sensors of ta, one without the first."""
    v, first = F.col("var"), (F.hour("t") < 12) & (F.col("site") != "S1")
    var = F.when(v == "ta", F.when(first, "ta_1_1_1").otherwise("ta_2_1_1")).when(v == "h", "ppfd_1_1_1").when(v == "p_rain", "p_3").otherwise(v)
    return sinks.summary_variables(obs(spark, d).withColumn("var", var)).select("site", "var", "mean_name", text().alias("t"), "value")


@query("ag9_compare_station_stats", "SELECT var, site, round(mean, 8) AS mean, abs(mean - rm) > 2 * rs AS off, abs(mean - rm) > 2 * greatest(std, rs) AS far_off FROM (SELECT site, var, avg(value) AS mean, stddev_samp(value) AS std FROM obs GROUP BY 1, 2) JOIN (SELECT var, avg(value) + 3 AS rm, stddev_samp(value) / 2 AS rs FROM obs WHERE site = 'S0' GROUP BY 1) USING (var)")
def ag9(spark, d):
    ref = obs(spark, d).where("site = 'S0'").groupBy("var").agg((F.avg("value") + 3).alias("ref_mean"), (F.stddev_samp("value") / 2).alias("ref_std"))
    return calendar.compare_stats(obs(spark, d), ref).select("var", "site", F.round("mean", 8).alias("mean"), "off", "far_off")


@query("ag10_fingerprint", "SELECT site, var, strftime(t, '%Y-%m-%d') AS date, " + ", ".join(f'avg(value) FILTER (slot = {i}) AS "{i}"' for i in range(48)) + " FROM gridv GROUP BY 1, 2, 3")
def ag10(spark, d):
    return calendar.fingerprint(gridded(spark, d))


@query("ag11_diurnal_cycle", "SELECT site, var, CAST(month(t) AS INTEGER) AS month, CAST(slot AS INTEGER) AS slot, round(avg(value), 8) AS mean, round(stddev_samp(value), 8) AS std, count(value) AS n FROM gridv GROUP BY 1, 2, 3, 4")
def ag11(spark, d):
    return calendar.diurnal_cycle(gridded(spark, d)).select("site", "var", "month", "slot", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"), "n")


UNITS = "u(var, unit, how) AS (VALUES ('nee', 'gC m-2 d-1', 'sum'), ('co2_flux', 'gC m-2 d-1', 'sum'), ('le', 'W m-2', 'mean'), ('h', 'W m-2', 'mean'), ('ta', 'degC', 'mean'), ('p_rain', 'mm', 'sum'))"
SCALE = f"(CASE WHEN unit LIKE 'gC%' THEN {calendar.CARBON!r}::DOUBLE ELSE 1 END * CASE WHEN how = 'sum' THEN 48 ELSE 1 END)"


@query("ag12_daily_sums", f"SELECT site, var, strftime(t, '%Y-%m-%d') AS date, round(avg(value) * {SCALE}, 8) AS total, round(stddev_samp(value) / sqrt(count(value)) * {SCALE}, 8) AS sd, unit, how FROM obs JOIN u USING (var) GROUP BY site, var, 3, unit, how", UNITS)
def ag12(spark, d):
    return calendar.daily_sums(obs(spark, d)).withColumns({"total": F.round("total", 8), "sd": F.round("sd", 8)})


@query("pr23_daily_sum_units", "SELECT DISTINCT var, unit, how FROM obs JOIN u USING (var)", UNITS)
def pr23(spark, d):
    return calendar.daily_sums(obs(spark, d)).select("var", "unit", "how").distinct()


@query("ag14_site_year", "SELECT site, CAST(floor(quantile_cont(year(t), 0.5)) AS INTEGER) AS year FROM o GROUP BY 1", ORDERS)
def ag14(spark, d):
    return calendar.site_year(days(spark, d))


@query("ag15_partition_quantile_limits", "SELECT site, var, min(value) AS lo, round(quantile_cont(value, 0.99), 8) AS hi FROM obs GROUP BY 1, 2")
def ag15(spark, d):
    return calendar.limits(obs(spark, d)).withColumn("hi", F.round("hi", 8))


# ---- checks

HEAD = "hd AS (SELECT DISTINCT l_orderkey AS file, l_linenumber - 1 AS pos, CASE l_partkey % 7 WHEN 0 THEN 'TIMESTAMP_START' WHEN 1 THEN 'FC_' || (l_suppkey % 3 + 1) || '_1_1' WHEN 2 THEN 'H_1_1_1' WHEN 3 THEN 'LE_1_1' WHEN 4 THEN 'NOPE_1_1_1' WHEN 5 THEN 'TAU_1_1_1' ELSE 'TAU_SSITC_TEST_1_1_1' END AS name FROM lineitem)"
STEM = "regexp_replace(name, '_[0-9]+_[0-9]+_[0-9]+$', '')"


def headers(spark, d):
    i = F.col("l_partkey") % 7
    name = F.when(i == 0, "TIMESTAMP_START").when(i == 1, F.concat(F.lit("FC_"), (F.col("l_suppkey") % 3 + 1).cast("string"), F.lit("_1_1")))
    for k, v in ((2, "H_1_1_1"), (3, "LE_1_1"), (4, "NOPE_1_1_1"), (5, "TAU_1_1_1")):
        name = name.when(i == k, v)
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("file"), (F.col("l_linenumber") - 1).alias("pos"), name.otherwise("TAU_SSITC_TEST_1_1_1").alias("name")).distinct()


@query("dq1_header_lint", f"""SELECT file, name, 'time column misplaced' AS problem FROM hd WHERE name = 'TIMESTAMP_START' AND pos <> 0
UNION ALL SELECT file, name, 'duplicate' FROM hd GROUP BY file, name HAVING count(*) > 1
UNION ALL SELECT file, name, 'bad suffix' FROM hd WHERE name <> 'TIMESTAMP_START' AND NOT regexp_matches(name, '_[0-9]+_[0-9]+_[0-9]+$')
UNION ALL SELECT file, name, 'index gap' FROM (SELECT *, i - lag(i, 1, 0) OVER (PARTITION BY file, stem ORDER BY i, name) AS gap FROM (SELECT DISTINCT file, name, {STEM} AS stem, CAST(regexp_extract(name, '_([0-9]+)_[0-9]+_[0-9]+$', 1) AS INTEGER) AS i FROM hd WHERE regexp_matches(name, '_[0-9]+_[0-9]+_[0-9]+$'))) WHERE gap > 1
UNION ALL SELECT file, name, 'unknown' FROM hd WHERE name <> 'TIMESTAMP_START' AND {STEM} NOT IN ('FC', 'H', 'LE', 'TAU', 'TAU_SSITC_TEST')""", HEAD)
def dq1(spark, d):
    return tables.header_lint(headers(spark, d), ["FC", "H", "LE", "TAU", "TAU_SSITC_TEST"])


LINK = ", ".join(f"('{v}', '{c}')" for v, cs in tables.LINKED.items() for c in cs)


@query("dq2_linked_columns", f"SELECT file, var, missing FROM (SELECT DISTINCT file, {STEM} AS var FROM hd) JOIN (VALUES {LINK}) l(var, missing) USING (var) WHERE (file, missing) NOT IN (SELECT file, {STEM} FROM hd)", HEAD)
def dq2(spark, d):
    return tables.linked_columns(headers(spark, d))


@query("dq3_time_column_check", "SELECT site AS file, CAST(sum(CASE WHEN t IS NULL THEN n ELSE 0 END) AS BIGINT) AS unparsed, count(DISTINCT CASE WHEN t < last THEN year(t) END) AS years, CAST(sum(CASE WHEN t IS NOT NULL THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicates FROM (SELECT *, max(t) OVER (PARTITION BY site) AS last FROM (SELECT 'C' || (o_custkey % 3) AS site, CASE WHEN o_orderkey % 50 <> 7 THEN o_orderdate END AS t, count(*) AS n FROM orders GROUP BY 1, 2)) GROUP BY 1")
def dq3(spark, d):
    raw = F.when(F.col("o_orderkey") % 50 == 7, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    own = table(spark, d, "orders").select(F.concat(F.lit("C"), (F.col("o_custkey") % 3).cast("string")).alias("file"), raw.alias("raw"))
    return tables.time_column_check(own, "raw", "yyyy-MM-dd")


RAW = "rw AS (SELECT 'S' || (user_id % 4) AS site, event_type AS var, CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN '-9999' WHEN 2 THEN 'Infinity' WHEN 3 THEN 'abc' ELSE '1.5' END AS raw FROM events)"


@query("dq5_value_check", "SELECT site, var, count(*) AS n, count(*) FILTER (raw = '') AS empty, count(*) FILTER (raw = '-9999') AS coded, count(*) FILTER (raw = 'Infinity') AS infinite, count(*) FILTER (raw = 'abc') AS not_numeric FROM rw GROUP BY 1, 2", RAW)
def dq5(spark, d):
    i = F.col("event_id") % 6
    raw = F.when(i == 0, "").when(i == 1, "-9999").when(i == 2, "Infinity").when(i == 3, "abc").otherwise("1.5")
    return tables.value_check(table(spark, d, "events").select(F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("site"), F.col("event_type").alias("var"), raw.alias("raw")))


@query("dq6_error_total", f"SELECT 0 AS check, (SELECT count(*) FROM hd WHERE name = 'NOPE_1_1_1') AS errors UNION ALL SELECT 1, (SELECT count(*) FROM (SELECT DISTINCT file, {STEM} AS var FROM hd) JOIN (VALUES {LINK}) l(var, missing) USING (var) WHERE (file, missing) NOT IN (SELECT file, {STEM} FROM hd))", HEAD)
def dq6(spark, d):
    own = headers(spark, d)
    return tables.error_total(own.where("name = 'NOPE_1_1_1'"), tables.linked_columns(own))


@query("dq7_unknown_and_unused_columns", "SELECT file, name, CASE WHEN name IN ('H_1_1_1') THEN 'unused' ELSE 'unknown' END AS problem FROM hd WHERE name NOT IN ('TAU_1_1_1', 'TIMESTAMP_START')", HEAD)
def dq7(spark, d):
    vocabulary = spark.createDataFrame([("H_1_1_1", False), ("TAU_1_1_1", True), ("TIMESTAMP_START", True)], "name string, used boolean")
    return tables.unknown_and_unused(headers(spark, d), vocabulary)


CELLS = """ce AS (SELECT user_id AS file, event_id % 4 AS row, event_type AS cell FROM events), vo(type, name) AS (VALUES ('EDDYPRO_FO', 'view'), ('EDDYPRO_FO', 'click'), ('CSF', 'purchase'), ('IAS', 'signup'), ('EDDYPRO_BIOMET', 'error')),
ty AS (SELECT file, CASE WHEN count(k) = 1 THEN min(CASE WHEN k IS NOT NULL THEN type END) ELSE 'UNKNOWN' END AS type FROM (SELECT DISTINCT file FROM ce) LEFT JOIN (SELECT file, row, type, count(*) AS k FROM ce JOIN vo ON cell = name JOIN (SELECT file, row, count(*) AS n FROM ce GROUP BY 1, 2) USING (file, row) GROUP BY file, row, type, n HAVING count(*) / n > 0.5) USING (file) GROUP BY file)"""


def file_types(spark, d):
    own = table(spark, d, "events").select(F.col("user_id").alias("file"), (F.col("event_id") % 4).alias("row"), F.col("event_type").alias("cell"))
    words = spark.createDataFrame([("EDDYPRO_FO", "view"), ("EDDYPRO_FO", "click"), ("CSF", "purchase"), ("IAS", "signup"), ("EDDYPRO_BIOMET", "error")], "type string, name string")
    return tables.detect_file_type(own, words)


@query("src3_detect_file_type", "SELECT * FROM ty", CELLS)
def src3(spark, d):
    return file_types(spark, d)


@query("dq8_unknown_files", "SELECT file FROM ty WHERE type = 'UNKNOWN'", CELLS)
def dq8(spark, d):
    return file_types(spark, d).where("type = 'UNKNOWN'").select("file")


@query("src4_detect_import_mode", "SELECT site, CASE WHEN f + c + i = 1 THEN CASE WHEN f = 1 THEN CASE WHEN b THEN 'EDDYPRO_FO_AND_BIOMET' ELSE 'EDDYPRO_FO' END WHEN i = 1 THEN 'IAS' ELSE CASE WHEN b THEN 'CSF_AND_BIOMET' ELSE 'CSF' END END END AS mode FROM (SELECT site, max(CAST(v = 'purchase' AS INTEGER)) AS f, max(CAST(v = 'click' AS INTEGER)) AS c, max(CAST(v = 'view' AS INTEGER)) AS i, bool_or(v = 'signup') AS b FROM (SELECT event_id // 3 AS site, event_type AS v FROM events) GROUP BY site)")
def src4(spark, d):
    i = F.col("event_type")
    kind = F.when(i == "purchase", "EDDYPRO_FO").when(i == "click", "CSF").when(i == "view", "IAS").when(i == "signup", "EDDYPRO_BIOMET").otherwise("UNKNOWN")
    return tables.detect_import_mode(table(spark, d, "events").select(F.floor(F.col("event_id") / 3).alias("site"), kind.alias("type")))


@query("src5_site_from_path", "SELECT name, CASE k WHEN 3 THEN 'n' || s_suppkey WHEN 4 THEN 'unknown_site' ELSE 'Site_' || s_suppkey END AS site, CASE WHEN k = 0 THEN 'v01' END AS version FROM (SELECT s_suppkey, s_suppkey % 5 AS k, CASE s_suppkey % 5 WHEN 0 THEN 'Site ' || s_suppkey || '_2023_v01.csv' WHEN 1 THEN 'Site_' || s_suppkey || '_CSF_2024_a.csv' WHEN 2 THEN 'Site_' || s_suppkey || '_FO_23.csv' WHEN 3 THEN 'eddy pro n' || s_suppkey || ' 2023.csv' ELSE 'data.csv' END AS name FROM supplier)")
def src5(spark, d):
    i, n = F.col("s_suppkey") % 5, F.col("s_suppkey").cast("string")
    name = F.when(i == 0, F.concat(F.lit("Site "), n, F.lit("_2023_v01.csv"))).when(i == 1, F.concat(F.lit("Site_"), n, F.lit("_CSF_2024_a.csv"))).when(i == 2, F.concat(F.lit("Site_"), n, F.lit("_FO_23.csv"))).when(i == 3, F.concat(F.lit("eddy pro n"), n, F.lit(" 2023.csv"))).otherwise("data.csv")
    site, version = tables.site_from_name(F.col("name"))
    return table(spark, d, "supplier").select(name.alias("name")).select("name", site.alias("site"), version.alias("version"))


@query("pr7_align_columns", "SELECT CAST(pos - 1 AS INTEGER) AS pos, name FROM (SELECT unnest(['site', 't', 'co2_flux', 'co2_flux_sqc', 'nee', 'h', 'h_sqc', 'le', 'ta', 'swin', 'rh', 'rain', 'air', 'u_star', 'co2_signal_strength', 'ch4_signal_strength', 'other']) AS name, generate_subscripts(['site', 't', 'co2_flux', 'co2_flux_sqc', 'nee', 'h', 'h_sqc', 'le', 'ta', 'swin', 'rh', 'rain', 'air', 'u_star', 'co2_signal_strength', 'ch4_signal_strength', 'other'], 1) AS pos) WHERE (SELECT count(*) FROM wide) > 0")
def pr7_align(spark, d):
    """Completeness columns are put right after their values by a rule; the table's columns as it then has them."""
    own = wide(spark, d)
    both = own.withColumns({"other": F.lit(1), "h_sqc": F.lit(1.0), "co2_flux_sqc": F.lit(1.0)})
    both = both.select(*tables.align_columns(own.columns, ["other", "h_sqc", "co2_flux_sqc"], lambda c: c[:-4] if c.endswith("_sqc") else None))
    return both.agg(F.count("*").alias("n")).where("n > 0").select(F.posexplode(F.array(*map(F.lit, both.columns))).alias("pos", "name"))


# ---- readers, over files that Spark writes from the tables


def folder(spark) -> str:
    """In the shared folder; on a cluster that names none there is no place that all executors see."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-stations-")
    return f"{shared}/stations-{uuid.uuid4().hex}"


def exported(df, by: list[str], units: dict[str, str] | None = None):
    """The table as it comes back from the files that the sink wrote."""
    path = folder(df.sparkSession)
    sinks.write(df, path, by, "csv", units)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path).select(*df.columns)


def written(spark, rows, header: list[str], path: str | None = None) -> str:
    """A folder (a new one, or more files in the given one) with one text file a site: the header lines, then `line` in order of t."""
    head = rows.select("site").distinct().withColumn("k", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(h).alias("line")) for i, h in enumerate(header))))).select("site", "k.i", F.lit(None).cast("timestamp_ntz").alias("t"), "k.line")
    both = head.unionByName(rows.select("site", F.lit(len(header)).alias("i"), "t", "line"))
    path = path or folder(spark)
    both.repartition("site").sortWithinPartitions("site", "i", "t").select("site", F.col("line").alias("value")).write.mode("append").partitionBy("site").text(path)
    return path


def cell(c):
    return F.coalesce(c.cast("string"), F.lit("-9999"))


FLUXES = "long AS (SELECT site, t, 'co2_flux' AS var, co2_flux AS value FROM wide UNION ALL SELECT site, t, 'h', h FROM wide), lg AS (SELECT g.site, g.var, g.t, l.value FROM (SELECT site, var, unnest(generate_series(min(t), max(t), INTERVAL '30 minutes')) AS t FROM long GROUP BY 1, 2) g LEFT JOIN long l USING (site, var, t))"
READ = f"SELECT site, var, {T}, value FROM lg"


def read(spark, path, layout, step="30 MINUTES", biomet=None):
    own = station_files.read_layout(spark, path, layout, step)
    if biomet:
        own = station_files.merge_biomet(own, station_files.read_layout(spark, biomet, "biomet", step))
    return own.select("site", "var", text().alias("t"), "value")


def weather_files(spark, d):
    line = F.concat_ws(",", F.date_format("t", "yyyy-MM-dd HHmm"), cell(F.col("rh")), cell(F.col("rh")))
    return written(spark, meteo(spark, d).withColumn("line", line), ["TIMESTAMP_1,RH_1_1_1,h", "yyyy-mm-dd HHMM,%,W"])


@query("src1_read_station_csv", f"SELECT site, var, {T}, value FROM long", FLUXES)
def src1(spark, d):
    line = F.concat_ws(",", F.date_format("t", "d.M.yyyy H:mm"), cell(F.col("co2_flux")), cell(F.col("h")))
    path = written(spark, wide(spark, d).withColumn("line", line), ["when,co2_flux,H"])
    return station_files.read_station_csv(spark, path, ["when"], ["d.M.yyyy H:mm", "yyyy-M-d H:mm"], 0, 1, {"H": "h"}, ",", None).select("site", "var", text().alias("t"), "value")


@query("src1_stamp_converter", f"SELECT site, var, {T}, value FROM long", FLUXES)
def src1_converter(spark, d):
    """Stamps as days and seconds since 1970, made times by the caller's function."""
    seconds = F.unix_seconds(F.col("t").cast("timestamp"))
    line = F.concat_ws(",", F.floor(seconds / 86400).cast("string"), cell(F.col("co2_flux")), (seconds % 86400).cast("string"), cell(F.col("h")))
    path = written(spark, wide(spark, d).withColumn("line", line), ["day,co2_flux,second,H"])
    parts = lambda text: F.split(text, " ")
    convert = lambda text: F.timestamp_seconds(parts(text)[0].try_cast("long") * 86400 + parts(text)[1].try_cast("long"))
    return station_files.read_station_csv(spark, path, ["day", "second"], step=None, converter=convert).select("site", "var", text().alias("t"), "value")


@query("src3_read_folder", f"{READ} WHERE var <> 'h' AND site <> 'S3' UNION ALL SELECT site, v, {T}, rh FROM meteo_grid CROSS JOIN (VALUES ('rh'), ('h')) u(v) WHERE site <> 'S3' UNION ALL SELECT site, 'co2_flux', {T}, value FROM lg WHERE var = 'co2_flux' AND site = 'S3'", FLUXES + ", meteo_grid AS (SELECT site, t, rh FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL '30 minutes')) AS t FROM meteo GROUP BY 1) LEFT JOIN meteo USING (site, t))")
def src3_folder(spark, d):
    """One folder: logger and weather files of three sites (whose H is the weather files'), and an exchange file of the fourth."""
    own = wide(spark, d)
    line = F.concat_ws(",", F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit("1"), cell(F.col("co2_flux")), cell(F.col("h")))
    path = written(spark, own.where("site <> 'S3'").withColumn("line", line), ["TOA5,x", "TIMESTAMP,RECORD,FC,H", "TS,RN,umol,W", ",,,"])
    weather = F.concat_ws(",", F.date_format("t", "yyyy-MM-dd HHmm"), cell(F.col("rh")), cell(F.col("rh")))
    written(spark, meteo(spark, d).where("site <> 'S3'").withColumn("line", weather), ["TIMESTAMP_1,RH_1_1_1,h", "yyyy-mm-dd HHMM,%,W"], path)
    exchange = F.concat_ws(",", F.date_format("t", "yyyyMMddHHmm"), F.date_format(F.expr("t + INTERVAL 30 MINUTES"), "yyyyMMddHHmm"), cell(F.col("co2_flux")))
    written(spark, own.where("site = 'S3'").withColumn("line", exchange), ["TIMESTAMP_START,TIMESTAMP_END,FC_1_1_1"], path)
    return station_files.read_folder(spark, path).select("site", "var", text().alias("t"), "value")


@query("src2_guess_table_start", "SELECT DISTINCT 'S' || (user_id % 4) AS site, 2 AS start FROM events")
def src2(spark, d):
    path = written(spark, wide(spark, d).withColumn("line", F.concat_ws(",", text(), cell(F.col("h")), cell(F.col("le")))), ["station", "made,by", "t,h,le"])
    got = station_files.guess_table_start(station_files.texts(spark, path))
    return got.select(F.regexp_extract("file", "site=([^/]*)", 1).alias("site"), "start")


@query("src6_read_eddypro_full_output", READ, FLUXES)
def src6(spark, d):
    line = F.concat_ws(",", F.lit("f"), F.date_format("t", "yyyy-MM-dd"), F.date_format("t", "HH:mm"), cell(F.col("co2_flux")), cell(F.col("h")))
    return read(spark, written(spark, wide(spark, d).withColumn("line", line), ["file_info,,,fluxes,", "filename,date,time,co2_flux,H", ",[yyyy-mm-dd],[HH:MM],[umol],[W]"]), "eddypro")


@query("src7_read_biomet", f"SELECT site, 'rh' AS var, {T}, rh AS value FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL '1 hour')) AS t FROM meteo GROUP BY 1) LEFT JOIN meteo USING (site, t)")
def src7(spark, d):
    """Files of half-hourly rows, read at an hourly flux step."""
    line = F.concat_ws(",", F.date_format("t", "yyyy-MM-dd HHmm"), cell(F.col("rh")))
    return read(spark, written(spark, meteo(spark, d).withColumn("line", line), ["TIMESTAMP_1,RH_1_1_1", "yyyy-mm-dd HHMM,%"]), "biomet", "1 HOUR")


@query("src8_read_csf", f"{READ} WHERE var <> 'h' UNION ALL SELECT site, 'rh', {T}, rh FROM meteo_grid UNION ALL SELECT site, 'h', {T}, rh FROM meteo_grid", FLUXES + ", meteo_grid AS (SELECT site, t, rh FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL '30 minutes')) AS t FROM meteo GROUP BY 1) LEFT JOIN meteo USING (site, t))")
def src8(spark, d):
    """Merged with weather files, whose variables win (here H too)."""
    line = F.concat_ws(",", F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit("1"), F.coalesce(F.col("co2_flux").cast("string"), F.lit("NAN")), cell(F.col("h")))
    return read(spark, written(spark, wide(spark, d).withColumn("line", line), ["TOA5,x", "TIMESTAMP,RECORD,FC,H", "TS,RN,umol,W", ",,,"]), "csf", biomet=weather_files(spark, d))


@query("src9_read_ias", f"SELECT site, var, {T}, CASE WHEN var = 'vpd' THEN round(value, 8) ELSE value END AS value FROM (SELECT site, t, v.var, CASE WHEN v.var = 'vpd' THEN rh * 0.1 ELSE co2_flux END AS value FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL '30 minutes')) AS t FROM wide GROUP BY 1) LEFT JOIN wide USING (site, t) CROSS JOIN (VALUES ('co2_flux'), ('vpd')) v(var))")
def src9(spark, d):
    line = F.concat_ws(",", F.date_format("t", "yyyyMMddHHmm"), F.date_format(F.expr("t + INTERVAL 30 MINUTES"), "yyyyMMddHHmm"), cell(F.col("co2_flux")), cell(F.col("rh")))
    got = read(spark, written(spark, wide(spark, d).withColumn("line", line), ["TIMESTAMP_START,TIMESTAMP_END,FC_1_1_1,VPD_PI_1_1_1"]), "ias")
    return got.withColumn("value", F.when(F.col("var") == "vpd", F.round("value", 8)).otherwise(F.col("value")))


def level3_wide(spark, d):
    return wide(spark, d).withColumn("vpd", derive.kpa(F.col("rh")))


L3 = "SELECT site, CAST(year(t) AS INTEGER) AS \"Year\", CAST(dayofyear(t) AS INTEGER) AS \"DoY\", hour(t) + minute(t) / 60 AS \"Hour\", coalesce(nee, -9999) AS \"NEE\", coalesce(le, -9999) AS \"LE\", coalesce(h, -9999) AS \"H\", swin AS \"Rg\", coalesce(ta, -9999) AS \"Tair\", rh AS \"rH\", rh * 0.1 AS \"VPD\", u_star AS \"Ustar\" FROM (SELECT *, min(CASE WHEN hour(t) = 0 AND minute(t) = 30 THEN t END) OVER (PARTITION BY site) AS f FROM wide) WHERE t >= f"


@query("snk1_write_level3", L3)
def snk1(spark, d):
    return exported(sinks.level3(level3_wide(spark, d)), ["site"], {"NEE": "umol_m-2_s-1", "Rg": "Wm-2", "VPD": "hPa"})


@query("src10_read_level3", f"SELECT site, {T}, nee AS \"NEE\", h AS \"H\", u_star AS \"Ustar\" FROM (SELECT *, min(CASE WHEN hour(t) = 0 AND minute(t) = 30 THEN t END) OVER (PARTITION BY site) AS f FROM wide) WHERE t >= f")
def src10(spark, d):
    own = sinks.level3(level3_wide(spark, d))
    names = [c for c in own.columns if c != "site"]
    rows = own.withColumn("t", F.expr("timestampadd(MINUTE, cast(Hour * 60 as int), make_date(Year, 1, 1) + cast(DoY - 1 as int))").cast("timestamp_ntz")).withColumn("line", F.concat_ws(" ", *(F.col(c).cast("string") for c in names)))
    got = station_files.read_level3(spark, written(spark, rows, [" ".join(names), " ".join("-" for _ in names)]))
    return got.select(F.regexp_extract("file", "site=([^/]*)", 1).alias("site"), text().alias("t"), "NEE", "H", "Ustar")


@query("snk2_write_ias", "SELECT site, CAST(year(t) AS INTEGER) AS year, strftime(t, '%Y%m%d%H%M') AS \"TIMESTAMP_START\", strftime(t + INTERVAL 30 MINUTE, '%Y%m%d%H%M') AS \"TIMESTAMP_END\", round(dayofyear(t + INTERVAL 30 MINUTE) + (hour(t + INTERVAL 30 MINUTE) * 60 + minute(t + INTERVAL 30 MINUTE)) / 1440, 3) AS \"DTime\", coalesce(co2_flux, -9999) AS \"FC_1_1_1\", coalesce(le, -9999) AS \"LE_1_1_1\", coalesce(h, -9999) AS \"H_1_1_1\", u_star AS \"USTAR_1_1_1\", coalesce(ta, -9999) AS \"TA_1_1_1\", rh AS \"RH_1_1_1\", swin AS \"SW_IN_1_1_1\", round(rh * 0.1 * 10, 8) AS \"VPD_PI_1_1_1\" FROM wide")
def snk2(spark, d):
    return exported(sinks.ias(level3_wide(spark, d)).withColumn("VPD_PI_1_1_1", F.round("VPD_PI_1_1_1", 8)), ["site", "year"])


@query("snk2_write_ias_months", "SELECT site, interval, CAST(row_number() OVER (PARTITION BY site, interval ORDER BY t) AS INTEGER) AS row, strftime(t, '%Y%m%d%H%M') AS \"TIMESTAMP_START\", coalesce(co2_flux, -9999) AS \"FC_1_1_1\", rh AS \"RH_1_1_1\" FROM (SELECT *, strftime(t, '%m.%Y') AS interval FROM wide) QUALIFY count(*) OVER (PARTITION BY site, interval) >= 5")
def snk2_months(spark, d):
    """One file for each site and month, read back line by line: row 0 holds the names."""
    path = folder(spark)
    own = sinks.ias(timegrid.split_by_interval(level3_wide(spark, d), "month"), ["interval"]).select("site", "interval", "TIMESTAMP_START", "FC_1_1_1", "RH_1_1_1")
    sinks.write_tables(own, path, ["site", "interval"], ["TIMESTAMP_START"])
    month = F.regexp_extract("path", "interval=([^/]*)", 1)  # as text: a partition value would be read as a number
    files = spark.read.format("binaryFile").load(path).select("site", month.alias("interval"), F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("row", "line"))
    cells = F.split("line", ",")
    return files.where("row > 0 and line <> ''").select("site", "interval", "row", cells[0].alias("TIMESTAMP_START"), cells[1].cast("double").alias("FC_1_1_1"), cells[2].cast("double").alias("RH_1_1_1"))


@query("snk6_write_averages_files", "SELECT site, 'site,level,year,month,dom,doy,hour,q,q_sqc' AS names, '--,--,--,--,--,--,--,pieces,--' AS units, count(*) AS n FROM (SELECT site FROM lineitem_t GROUP BY site, year(t), month(t), hour(t) + minute(t) / 60) GROUP BY 1", PAIRS)
def snk6_files(spark, d):
    """A site's hourly averages as one file with a line of names and one of units."""
    path = folder(spark)
    own = sinks.averages(means(spark, d), "hourly", ["q", "q_sqc"]).withColumns({"station": F.col("site"), "level": F.lit("hourly")}).select("station", "site", "level", "year", "month", "dom", "doy", "hour", "q", "q_sqc")
    sinks.write_tables(own, path, ["station"], ["year", "month", "hour"], {"q": "pieces"})
    rows = F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: x != "")
    return spark.read.format("binaryFile").load(path).select(F.col("station").alias("site"), rows[0].alias("names"), rows[1].alias("units"), (F.size(rows) - 2).cast("long").alias("n"))


@query("snk3_write_fat", "SELECT site, year, \"DoY\", period, var, value, gapfilled FROM (SELECT site, CAST(year(t) AS INTEGER) AS year, round(dayofyear(t) + hour(t) / 24 + minute(t) / 24 / 60, 3) AS \"DoY\", CAST(month(t) % 12 // 3 + 1 AS INTEGER) AS period, var, coalesce(value, -99999) AS value, round(coalesce(filled, CASE WHEN count(value) OVER w >= 4 THEN avg(value) OVER w END, -99999), 8) AS gapfilled, count(*) OVER (PARTITION BY site, var, year(t)) AS n FROM i2 WINDOW w AS (PARTITION BY site, var, slot ORDER BY t ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)) WHERE n >= 5", INTERP)
def snk3(spark, d):
    return exported(sinks.fat(gridded(spark, d)).withColumn("gapfilled", F.round("gapfilled", 8)), ["site", "year"])


@query("snk4_write_output_all", "SELECT site, strftime(t, '%Y-%m-%d') AS date, strftime(t, '%H:%M') AS time, var, coalesce(value, -9999) AS value, CAST(f_qc AS INTEGER) AS f_qc, CAST(f_minmax AS INTEGER) AS f_minmax, CAST(f_quantile AS INTEGER) AS f_quantile FROM c3", CHAIN)
def snk4(spark, d):
    return exported(sinks.output_all(chain(spark, d), list(FLAGS)), ["site"])


@query("snk6_write_averages", "SELECT site, year, month, dom, doy, CASE WHEN h IS NOT NULL THEN printf('%02d:%02d', CAST(floor(h) AS INTEGER), CAST(round((h - floor(h)) * 60) AS INTEGER)) END AS hour, q, q_sqc FROM (SELECT site, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(NULL AS INTEGER) AS dom, CAST(NULL AS INTEGER) AS doy, hour(t) + minute(t) / 60 AS h, round(avg(q), 8) AS q, round(count(raw) / count(*), 8) AS q_sqc FROM lineitem_t GROUP BY ALL)", PAIRS)
def snk6(spark, d):
    return exported(sinks.averages(means(spark, d), "hourly", ["q", "q_sqc"]), ["site"], {"q": "pieces"})


@query("snk7_write_filled", f"SELECT site, {T}, co2_flux, rh AS rh_f FROM wide")
def snk7(spark, d):
    raw = wide(spark, d).select("site", "t", "co2_flux")
    return exported(sinks.filled_table(raw, meteo(spark, d).withColumnRenamed("rh", "rh_f"), ["rh_f"]).select("site", text().alias("t"), "co2_flux", "rh_f"), ["site"])


@query("snk7_write_fluxnet15", "SELECT site, CAST(year(t) AS INTEGER) AS year, strftime(t - INTERVAL 30 MINUTE, '%Y%m%d%H%M') AS \"TIMESTAMP_START\", strftime(t, '%Y%m%d%H%M') AS \"TIMESTAMP_END\", coalesce(nee, -9999) AS \"NEE_VUT_REF\", coalesce(le, -9999) AS \"LE_F_MDS\", coalesce(h, -9999) AS \"H_F_MDS\", swin AS \"SW_IN_F_MDS\", coalesce(ta, -9999) AS \"TA_F_MDS\", rh AS \"RH\", round(rh * 0.1 * 10, 8) AS \"VPD_F_MDS\", u_star AS \"USTAR\" FROM wide")
def snk7_fluxnet(spark, d):
    return exported(sinks.fluxnet15(level3_wide(spark, d)).withColumn("VPD_F_MDS", F.round("VPD_F_MDS", 8)), ["site", "year"])


@query("src10_read_fluxnet15", f"SELECT site, {T}, v.var, round(CASE v.var WHEN 'nee' THEN nee WHEN 'vpd' THEN rh * 0.1 ELSE u_star END, 8) AS value FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL '30 minutes')) AS t FROM wide GROUP BY 1) LEFT JOIN wide USING (site, t) CROSS JOIN (VALUES ('nee'), ('vpd'), ('u_star')) v(var)")
def src10_fluxnet(spark, d):
    """The export above, as files of a site, read back."""
    own = sinks.fluxnet15(level3_wide(spark, d).select("site", "t", "nee", "vpd", "u_star"))
    names = [c for c in own.columns if c not in ("site", "year")]
    rows = own.withColumn("t", F.to_timestamp("TIMESTAMP_END", "yyyyMMddHHmm").cast("timestamp_ntz")).withColumn("line", F.concat_ws(",", *(F.col(c).cast("string") for c in names)))
    return read(spark, written(spark, rows, [",".join(names)]), "fluxnet15").withColumn("value", F.round("value", 8))
