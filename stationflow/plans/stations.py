"""Station series derived from the event table: what the registered queries run on, and the same as SQL.

site is user_id modulo 4, t the half hour, variables the event types. Values come from integer cents, so both engines get the same doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timegrid import repair_time

VARS = {"view": "co2_flux", "click": "h", "purchase": "le", "signup": "ta", "error": "p_rain"}
DRIVERS = ("swin", "rh", "rain", "air", "u_star", "co2_signal_strength", "ch4_signal_strength")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _events(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "events").withColumn("t", F.window("ts", "30 minutes")["start"])
    return own.withColumns({"site": F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")), "cents": F.round(F.col("value") * 100).cast("long")})


def obs(spark: SparkSession, d: str) -> DataFrame:
    """site, t, var, value, qc; nee is a copy of co2_flux."""
    var = F.coalesce(*(F.when(F.col("event_type") == k, v) for k, v in VARS.items()))
    got = _events(spark, d).groupBy("site", "t", var.alias("var")).agg((F.sum("cents") / F.count("*") / 1000.0 - 5).alias("value"), (F.max("event_id") % 3).cast("int").alias("qc"))
    names = F.when(F.col("var") == "co2_flux", F.array(F.lit("co2_flux"), F.lit("nee"))).otherwise(F.array("var"))
    return got.withColumn("var", F.explode(names))


def slot() -> Column:
    return (F.hour("t") * 2 + F.floor(F.minute("t") / 30)).cast("int")


def meteo(spark: SparkSession, d: str) -> DataFrame:
    """site, t and the drivers."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    got = _events(spark, d).groupBy("site", "t").agg(
        (F.max("event_id") % 110).cast("double").alias("rh"), (F.count_if(F.col("event_type") == "error") * 0.125).alias("rain"),
        ((F.sum("cents") % 400) / 10.0 - 10).alias("air"), ((F.min("event_id") % 100) / 128.0).alias("u_star"),
        F.max(k).alias("co2_signal_strength"), F.min(k).alias("ch4_signal_strength"),
    )
    s = slot()
    return got.withColumn("swin", F.when(s.between(12, 36), (s - 12) * (36 - s) * 5.0).otherwise(0.0)).select("site", "t", *DRIVERS)


def full(spark: SparkSession, d: str) -> DataFrame:
    """Observations with their drivers."""
    return obs(spark, d).join(meteo(spark, d), ["site", "t"], "left").withColumn("p_rain", F.col("rain"))


def gridded(spark: SparkSession, d: str) -> DataFrame:
    """Each series completed to the regular grid, with slot and drivers."""
    got = repair_time(obs(spark, d), "30 MINUTES", ("site", "var"))
    return got.join(meteo(spark, d), ["site", "t"], "left").withColumns({"slot": slot(), "p_rain": F.col("rain")})


def wide(spark: SparkSession, d: str) -> DataFrame:
    """site, t, the variables as columns (null where none), the drivers."""
    names = ["co2_flux", "nee", "h", "le", "ta"]
    got = obs(spark, d).groupBy("site", "t").agg(*(F.max(F.when(F.col("var") == n, F.col("value"))).alias(n) for n in names))
    return got.join(meteo(spark, d), ["site", "t"])


def text(t: str = "t") -> Column:
    return F.date_format(t, "yyyy-MM-dd HH:mm:ss")


CTE = """
obs0 AS (SELECT 'S' || (user_id % 4) AS site, time_bucket(INTERVAL '30 minutes', ts) AS t,
  CASE event_type WHEN 'view' THEN 'co2_flux' WHEN 'click' THEN 'h' WHEN 'purchase' THEN 'le' WHEN 'signup' THEN 'ta' ELSE 'p_rain' END AS var,
  sum(CAST(round(value * 100) AS BIGINT)) / count(*) / 1000.0 - 5 AS value, CAST(max(event_id) % 3 AS INTEGER) AS qc FROM events GROUP BY ALL),
obs AS (SELECT * FROM obs0 UNION ALL SELECT site, t, 'nee', value, qc FROM obs0 WHERE var = 'co2_flux'),
meteo AS (SELECT *, CASE WHEN slot BETWEEN 12 AND 36 THEN (slot - 12) * (36 - slot) * 5.0::DOUBLE ELSE 0.0::DOUBLE END AS swin FROM (
  SELECT 'S' || (user_id % 4) AS site, time_bucket(INTERVAL '30 minutes', ts) AS t, hour(time_bucket(INTERVAL '30 minutes', ts)) * 2 + minute(time_bucket(INTERVAL '30 minutes', ts)) // 30 AS slot,
  CAST(max(event_id) % 110 AS DOUBLE) AS rh, (count(*) FILTER (event_type = 'error')) * 0.125::DOUBLE AS rain,
  (sum(CAST(round(value * 100) AS BIGINT)) % 400) / 10.0::DOUBLE - 10 AS air, (min(event_id) % 100) / 128.0::DOUBLE AS u_star,
  max(CAST(regexp_extract(props, '[0-9]+') AS INTEGER)) AS co2_signal_strength, min(CAST(regexp_extract(props, '[0-9]+') AS INTEGER)) AS ch4_signal_strength
  FROM events GROUP BY 1, 2, 3)),
allv AS (SELECT o.*, m.swin, m.rh, m.rain AS p_rain, m.air, m.u_star, m.co2_signal_strength, m.ch4_signal_strength FROM obs o LEFT JOIN meteo m USING (site, t)),
gridv AS (SELECT g.site, g.var, g.t, o.value, o.qc, m.swin, m.rh, m.rain AS p_rain, m.u_star, m.co2_signal_strength, m.ch4_signal_strength, hour(g.t) * 2 + minute(g.t) // 30 AS slot
  FROM (SELECT site, var, unnest(generate_series(min(t), max(t), INTERVAL '30 minutes')) AS t FROM obs GROUP BY site, var) g
  LEFT JOIN obs o USING (site, var, t) LEFT JOIN meteo m USING (site, t)),
wide AS (SELECT w.*, m.swin, m.rh, m.rain, m.air, m.u_star, m.co2_signal_strength, m.ch4_signal_strength FROM (
  SELECT site, t, max(value) FILTER (var = 'co2_flux') AS co2_flux, max(value) FILTER (var = 'nee') AS nee, max(value) FILTER (var = 'h') AS h,
  max(value) FILTER (var = 'le') AS le, max(value) FILTER (var = 'ta') AS ta FROM obs GROUP BY site, t) w JOIN meteo m USING (site, t))"""
T = "strftime(t, '%Y-%m-%d %H:%M:%S') AS t"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, more: str = ""):
    """Registers a query and its SQL (after the common table expressions, and `more` of them)."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {CTE}{', ' + more if more else ''} {sql}"
        return f

    return keep
