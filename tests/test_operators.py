"""Edge cases on small tables written by hand, and recovery of known parameters."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stationflow.operators import calendar, derive, filters, gapfill, partition, tables, timegrid, ustar

T0 = dt.datetime(2024, 1, 1)
HALF = dt.timedelta(minutes=30)


def series(spark, values, var="h", site="A", start=T0, qc=0):
    rows = [(site, start + i * HALF, var, v, qc) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "site string, t timestamp_ntz, var string, value double, qc int")


def values(df, column):
    return [r[column] for r in df.orderBy("site", "var", "t").collect()]


def test_missing_values_and_thresholds_keep_the_flag(spark):
    df = filters.min_max_filter(series(spark, [None, -1.0, 1.0, 1.5, -1.5]), {"h": (-1.0, 1.0)})
    assert values(df, "f_minmax") == [1, 1, 1, 0, 0]


def test_flags_only_ever_turn_off(spark):
    df = filters.min_max_filter(series(spark, [0.0, 5.0]), {"h": (-1.0, 1.0)})
    df = filters.custom_filter(df, F.col("value") == 0, "f_own", "f_minmax")
    assert values(df, "f_own") == [0, 0]
    assert values(filters.apply_flags(filters.collapse_flags(df, ["f_minmax", "f_own"])), "filtered") == [None, None]


def test_rain_reaches_forward_n_minus_one_steps(spark):
    df = series(spark, [1.0] * 6).withColumn("p_rain", F.when(F.minute("t") + 60 * F.hour("t") == 30, 1.0).otherwise(0.0))
    assert values(filters.rain_filter(df, 0.1, 3), "f_rain") == [1, 0, 0, 0, 1, 1]


def test_night_filter_compat_judges_le_by_h(spark):
    df = series(spark, [100.0], "le").withColumns({"swin": F.lit(0.0), "h_value": F.lit(0.0)})
    assert values(filters.night_filter(df, -5.0, (-50.0, 20.0), (-50.0, 20.0)), "f_night") == [0]
    assert values(filters.night_filter(df, -5.0, (-50.0, 20.0), (-50.0, 20.0), compat=True), "f_night") == [1]


def test_overlapping_ranges_add_no_rows(spark):
    ranges = spark.createDataFrame([("A", T0, T0 + HALF), ("A", T0, T0 + 2 * HALF)], "site string, start timestamp_ntz, stop timestamp_ntz")
    df = filters.winter_filter(series(spark, [9.0] * 4, "nee"), ranges, {"nee": (0.0, 5.0)})
    assert values(df, "f_winter") == [0, 0, 0, 1]


def test_repair_keeps_the_first_and_fills(spark):
    rows = [("A", T0, 1.0, 0), ("A", T0, 2.0, 1), ("A", T0 + 3 * HALF, 3.0, 2)]
    df = timegrid.repair_time(spark.createDataFrame(rows, "site string, t timestamp_ntz, value double, line int"), order=("line",))
    assert [r["value"] for r in df.orderBy("t").collect()] == [1.0, None, None, 3.0]
    again = timegrid.repair_time(df, order=("line",))
    assert [r["value"] for r in again.orderBy("t").collect()] == [1.0, None, None, 3.0]


def stamped(spark, **sites):
    rows = [(site, t, float(i), i) for site, stamps in sites.items() for i, t in enumerate(stamps)]
    return spark.createDataFrame(rows, "site string, t timestamp_ntz, value double, line int")


def test_a_stray_first_stamp_loses_nothing_else(spark):
    good = [T0 + i * HALF for i in range(20)]
    df = stamped(spark, A=[T0 - dt.timedelta(minutes=7), *good], B=good, C=[*good, good[3]])
    got, verdicts = timegrid.strict_repair(df, order=("line",))
    assert {r["site"]: (r["verdict"], r["off_grid"], r["duplicates"]) for r in verdicts.collect()} == {"A": ("repaired", 1, 0), "B": ("ok", 0, 0), "C": ("repaired", 0, 1)}
    assert all(got.where(f"site = '{s}' and value is not null").count() == 20 for s in "ABC")


def test_series_beyond_repair_are_told(spark):
    good = [T0 + i * HALF for i in range(20)]
    stray = [T0 + i * HALF + dt.timedelta(minutes=1) for i in (2, 5)]
    df = stamped(spark, A=good + stray, B=good, C=good[:5], D=[None] * 13)
    with pytest.raises(Exception, match="can't be repaired"):
        timegrid.strict_repair(df)[0].collect()
    got, verdicts = timegrid.strict_repair(df, fail=False)
    assert {r["site"] for r in got.select("site").distinct().collect()} == {"B"}
    assert {r["site"]: r["verdict"] for r in verdicts.collect()} == {"A": "irregular", "B": "ok", "C": "short", "D": "short"}
    assert timegrid.series_verdicts(stamped(spark)).count() == 0


def test_two_sites_together_are_each_alone(spark):
    a, b = series(spark, [1.0, None, 3.0]), series(spark, [5.0, None, None, 9.0], site="B")
    both = gapfill.interpolate_limit(a.union(b))
    assert values(both, "filled") == values(gapfill.interpolate_limit(a), "filled") + values(gapfill.interpolate_limit(b), "filled")


def test_interpolation_limits(spark):
    df = gapfill.interpolate_limit(series(spark, [None, 0.0, None, None, None, None, 5.0, None, None, None, None]))
    assert values(df, "filled") == [None, 0.0, 1.0, 2.0, 3.0, None, 5.0, 5.0, 5.0, 5.0, None]


def test_long_runs(spark):
    assert values(tables.filter_long_runs(series(spark, [1.0, 1.0, 1.0, 2.0, 2.0]), 3), "value_runs") == [None, None, None, 2.0, 2.0]


def test_parse_needs_exactly_one_format(spark):
    df = spark.createDataFrame([("a", "1.5.2023 0:30"), ("a", "2.5.2023 1:00"), ("b", "nonsense")], "file string, raw string")
    got = {(r["file"], r["raw"]): r["t"] for r in timegrid.parse_stamps(df, "raw", ["d.M.yyyy H:mm", "yyyy-M-d H:mm"], "file").collect()}
    assert got["a", "1.5.2023 0:30"] == dt.datetime(2023, 5, 1, 0, 30) and got["b", "nonsense"] is None


def test_codes_and_nan_become_null(spark):
    df = spark.createDataFrame([("-9999",), (" NAN ",), ("NaN",), ("x",), ("1.5",), (None,)], "raw string")
    assert [r[0] for r in df.select(tables.null_codes(F.col("raw"))).collect()] == [None, None, None, None, 1.5, None]


def test_humidity_and_deficit_are_inverse(spark):
    df = spark.createDataFrame([(20.0, 55.0), (-5.0, 90.0)], "ta double, rh double")
    got = df.select(derive.rh_from_vpd(F.col("ta"), derive.vpd_from_rh(F.col("ta"), F.col("rh")))).collect()
    assert [round(r[0], 9) for r in got] == [55.0, 90.0]


def test_december_counts_to_next_winter(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 12, 1),), (dt.datetime(2024, 2, 29),), (dt.datetime(2024, 3, 1),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(timegrid.season()).collect()] == ["2024-12", "2024-12", "2024-03"]


def test_calendar_levels_completeness_and_lone_year(spark):
    rows = [("A", dt.datetime(2023, 12, 31, 23, 30), 9.0, 9.0)] + [("A", T0 + i * HALF, float(i), None if i % 2 else 1.0) for i in range(96)]
    df = calendar.trim_short_years(spark.createDataFrame(rows, "site string, t timestamp_ntz, x_f double, x double"))
    got = calendar.calendar_means(df, {"x_f": "x"}).collect()
    assert {level: sum(r["level"] == level for r in got) for level in calendar.LEVELS} == {"hourly": 48, "daily": 2, "monthly": 1, "yearly": 1}
    assert next(r for r in got if r["level"] == "yearly")["x_f_sqc"] == 0.5


def test_night_partition_recovers_parameters(spark):
    e0, rref = 200, 3.0
    rows = []
    for i in range(20 * 48):
        ta = 5 + 10 * math.sin(i / 37)
        rows.append(("A", T0 + i * HALF, rref * math.exp(e0 * (1 / 61.02 - 1 / (ta + 46.02))), ta, 0.0))
    df = spark.createDataFrame(rows, "site string, t timestamp_ntz, nee double, ta double, swin double")
    got = partition.partition_night(df).collect()
    assert got and all(r["e0"] == e0 and abs(r["rref"] - rref) < 1e-6 for r in got)


def response(ta, e0):
    return math.exp(e0 * (1 / 61.02 - 1 / (ta + 46.02)))


def flux_rows(days, site="A", e0=180.0, rref=lambda day: 3.0, alpha=0.06, beta=25.0, k=0.04, noise=0.0, seed=1):
    """site, t, nee, ta, vpd (hPa), swin of a made-up season, and its true respiration and uptake."""
    import random

    rng = random.Random(seed)
    out = []
    for i in range(48 * days):
        slot = i % 48
        swin = max(0.0, 700 * math.sin((slot - 12) / 24 * math.pi)) if 12 < slot < 36 else 0.0
        ta = 12 + 7 * math.sin((slot - 16) / 24 * math.pi) + 3 * math.sin(i / 97)
        vpd = max(0.0, 9 + 9 * math.sin((slot - 18) / 24 * math.pi) + 3 * math.sin(i / 61))
        reco = rref(i / 48) * response(ta, e0)
        top = beta * math.exp(-k * max(0.0, vpd - 10))
        gpp = alpha * top * swin / (alpha * swin + top)
        out.append((site, T0 + i * HALF, reco - gpp + noise * rng.gauss(0, 1), ta, vpd, swin, reco, gpp))
    return out


FLUX = "site string, t timestamp_ntz, nee double, ta double, vpd double, swin double, reco_true double, gpp_true double"


def test_night_partition_follows_a_drifting_reference(spark):
    df = spark.createDataFrame(flux_rows(60, rref=lambda day: 2 + day / 30, noise=0.02), FLUX)
    e0 = partition.site_sensitivity(partition.night_sensitivity(df))
    assert abs(e0.where("year = 2024").first()["e0"] - 180) < 12
    marks = partition.night_reference(df, e0)
    assert all(abs(r["rref"] - (2 + (r["at"] - 1704067200) / 86400 / 30)) < 0.15 for r in marks.collect())
    got = partition.night_fluxes(df, marks).collect()
    assert len(got) == 48 * 60 and max(abs(r["reco"] - r["reco_true"]) for r in got) < 0.35
    assert all(r["gpp"] == pytest.approx(r["reco"] - r["nee"]) for r in got)


def test_windows_that_tell_no_sensitivity_are_refused(spark):
    constant = [(s, t, nee, 10.0, v, w, a, b) for s, t, nee, _, v, w, a, b in flux_rows(20)]
    falling = [("B", t, 5 - ta / 10, ta, v, 0.0, a, b) for _, t, _, ta, v, _, a, b in flux_rows(20)]
    fits = partition.night_sensitivity(spark.createDataFrame(constant + falling, FLUX))
    assert fits.count() == 0
    assert partition.night_fluxes(spark.createDataFrame(constant, FLUX), partition.night_reference(spark.createDataFrame(constant, FLUX), partition.site_sensitivity(fits))).where("reco is not null").count() == 0


def test_light_responses_recover_all_parameters(spark):
    df = spark.createDataFrame(flux_rows(16), FLUX)
    fits = partition.light_responses(df, partition.night_sensitivity(df, days=12, every=2)).collect()
    assert len(fits) >= 7 and all(r["how"] == "all" for r in fits)
    for r in fits:
        assert (r["alpha"], r["beta"], r["k"], r["rref"], r["e0"]) == pytest.approx((0.06, 25.0, 0.04, 3.0, 180.0), rel=0.02)
    got = partition.day_fluxes(df, partition.light_responses(df, partition.night_sensitivity(df, days=12, every=2))).collect()
    assert len(got) == 48 * 16
    assert all(abs(r["reco_dt"] - r["reco_true"]) < 0.05 and abs(r["gpp_dt"] - r["gpp_true"]) < 0.05 for r in got)


def test_light_response_cascade(spark):
    """Moist days: no k. Uptake that rises when it is dry: k would be negative. A slope beyond its bound: the last window's. Uptake in the dark: refused."""
    rows = flux_rows(40, noise=0.05)
    out = []
    for i, (s, t, nee, ta, vpd, swin, reco, gpp) in enumerate(rows):
        day = i / 48
        if day < 6:
            vpd = min(vpd, 9.0)
            nee = reco - 0.06 * 25 * swin / (0.06 * swin + 25)
        elif 12 <= day < 18:
            top = 25 * math.exp(0.02 * max(0.0, vpd - 10))
            nee = reco - 0.06 * top * swin / (0.06 * swin + top)
        elif 18 <= day < 27:
            slope = 0.15 if day < 22 else 0.25
            nee = reco - slope * 10 * swin / (slope * swin + 10)
        elif day >= 32:
            nee = nee - 20
        out.append((s, t, nee, ta, vpd, swin, reco, gpp))
    df = spark.createDataFrame(out, FLUX)
    how = {(r["at"] - 1704067200) / 86400: r for r in partition.light_responses(df, partition.night_sensitivity(df, days=12, every=2)).collect()}
    of = lambda lo, hi: {r["how"] for at, r in how.items() if lo + 2 <= at <= hi - 2}
    assert of(0, 6) == {"k0"} and of(12, 18) == {"k0"} and of(22, 27) <= {"alpha", "alpha_k0"} and of(33, 40) == {None}
    assert all(0 < r["alpha"] <= 0.22 and r["k"] >= 0 and r["beta"] > 0 for r in how.values() if r["how"])
    assert all(r["alpha"] is None for r in how.values() if r["how"] is None)


def test_marks_at_ends_and_at_the_stamp(spark):
    df = spark.createDataFrame([("A", T0 + i * HALF, float(i)) for i in range(5)] + [("B", T0, 0.0)], "site string, t timestamp_ntz, x double")
    at = 1704067200.0
    marks = spark.createDataFrame([("A", at + 1800, 10.0), ("A", at + 3 * 1800, 20.0)], "site string, at double, v double")
    got = partition.between_marks(df, marks, ["v"])
    got = got.withColumn("y", partition.linear(F.col("_at"), F.col("before"), F.col("after"), lambda m: m["v"]))
    assert [r["y"] for r in got.orderBy("site", "t").collect()] == [10.0, 10.0, 15.0, 20.0, 20.0, None]


def test_day_partition_recovers_parameters(spark):
    rows = [("A", T0 + i * HALF, 2 - 0.05 * 30 * x / (0.05 * x + 30), x) for i, x in enumerate([20.0 + 15 * j for j in range(60)])]
    r = partition.partition_day(spark.createDataFrame(rows, "site string, t timestamp_ntz, nee double, swin double")).first()
    assert r["converged"] and abs(r["alpha"] - 0.05) < 1e-3 and abs(r["beta"] - 30) < 0.1 and abs(r["gamma"] - 2) < 1e-2


def test_ustar_threshold_recovers_plateau(spark):
    rows = []
    for i in range(2000):
        u = (i * 37 % 1000) / 1000
        rows.append(("A", T0 + i * HALF, min(1.0, u / 0.3) * 5, (i * 13 % 50) / 2, u, 0.0, "all"))
    df = spark.createDataFrame(rows, "site string, t timestamp_ntz, nee double, ta double, u_star double, swin double, season string")
    assert 0.2 < ustar.threshold(df).first()["ustar"] < 0.4
    b = ustar.bootstrap(df, 20).first()
    assert b["U05"] <= b["U50"] <= b["U95"]


def ustar_table(spark, n=4000, seed=3):
    """Season `all` has a plateau from u* 0.3 on; in its warmest seventh u* follows the temperature; season `thin` has few rows."""
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(n):
        u, ta = rng.random(), 25 * rng.random()
        if ta > 21.5:
            u = (ta - 21.5) / 3.5
        rows.append(("A", T0 + i * HALF, min(1.0, u / 0.3) * 5 + 0.1 * rng.random() + (40 * u if ta > 21.5 else 0), ta, u, 0.0, "thin" if i < 100 else "all"))
    return spark.createDataFrame(rows, "site string, t timestamp_ntz, nee double, ta double, u_star double, swin double, season string")


def test_correlated_classes_and_thin_seasons(spark):
    df = ustar_table(spark)
    of = lambda **more: {r["season"]: r for r in ustar.pooled_thresholds(df, **more).collect()}
    got = of(least_class=50)
    assert not got["all"]["pooled"] and got["thin"]["pooled"] and got["thin"]["n"] == 100
    assert 0.2 < got["all"]["ustar"] < 0.35 and abs(got["thin"]["ustar"] - got["all"]["ustar"]) < 0.05
    hot = ustar.threshold(df.where("ta > 21.5"), classes=1, by=("site",))
    assert hot.first()["ustar"] > 0.6 and ustar.threshold(df.where("ta > 21.5"), classes=1, by=("site",), most_cor=0.5).count() == 0
    assert of(least_class=5000)["all"]["ustar"] is None and of(least_season=1, least_class=10)["thin"]["pooled"] is False


def test_weighted_tiles_equal_those_of_copies(spark):
    import random

    rng = random.Random(1)
    rows = [("A" if i % 3 else "B", i, rng.randrange(20), rng.randrange(1, 6)) for i in range(120)] + [("C", 1, 1, 2), ("C", 2, 1, 1)]
    df = spark.createDataFrame(rows, "site string, i int, x int, n long")
    copies = df.withColumn("c", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    want = {(r["site"], r["i"], r["k"]): r["n"] for r in ustar.tiles(copies, "k", 7, ["site"], ["x", "i"]).groupBy("site", "i", "k").agg(F.count("*").alias("n")).collect()}
    assert {(r["site"], r["i"], r["k"]): r["n"] for r in ustar.tiles(df, "k", 7, ["site"], ["x", "i"], "n").collect()} == want


def test_mds_prefers_similar_conditions(spark):
    rows = [("A", T0 + i * HALF, None if i == 48 * 3 + 24 else float(i % 48), 100.0 * (i % 48), 5.0, 10.0) for i in range(48 * 7)]
    df = spark.createDataFrame(rows, "site string, t timestamp_ntz, value double, rg double, vpd double, ta double")
    r = gapfill.mds_gap_fill(df).where("value is null").first()
    assert r["filled"] == 24.0 and r["stage"] == 1 and r["fqc"] == 1


def mds_table(spark, seed=5):
    """Thirty days with gaps of all lengths, as one series of a site and as two."""
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(48 * 34):
        gap = 48 * 5 < i < 48 * 26 and rng.random() < 0.97 or rng.random() < 0.3
        rows.append(("A", T0 + i * HALF, None if gap else rng.uniform(-5, 5), float(rng.randrange(0, 800, 40)), rng.uniform(0, 30), rng.uniform(0, 25)))
    return spark.createDataFrame(rows, "site string, t timestamp_ntz, value double, rg double, vpd double, ta double")


def test_series_together_are_each_alone(spark):
    """Carried rings of days give what one look-up of all windows gives; all stages occur; series with other gaps don't disturb each other."""
    df = mds_table(spark)
    alone = {r["t"]: r for r in gapfill.mds_gap_fill(df).collect()}
    other = df.select("site", "t", F.lit("le").alias("var"), F.when(F.hour("t") % 5 > 0, 7.0).alias("value"))
    both = df.select("site", "t", F.lit("nee").alias("var"), "value").unionByName(other)
    got = [r for r in gapfill.fill_series(both, df, ("var",)).where("var = 'nee'").collect()]
    assert len(got) == len(alone) and len({r["stage"] for r in got}) > 6
    for r in got:
        a = alone[r["t"]]
        assert (r["stage"], r["fqc"], r["fnum"]) == (a["stage"], a["fqc"], a["fnum"]) and r["filled"] == pytest.approx(a["filled"]) and r["fsd"] == pytest.approx(a["fsd"])


def test_deviations_of_measured_rows_only_where_wanted(spark):
    df = mds_table(spark)
    both = df.select("site", "t", F.lit("nee").alias("var"), "value").unionByName(df.select("site", "t", F.lit("ta").alias("var"), "value"))
    got = gapfill.fill_series(both, df, ("var",), F.col("var") == "nee").where("value is not null")
    assert got.where("var = 'ta' and (fsd is not null or stage <> 0)").count() == 0
    assert got.where("var = 'nee' and fsd is null").count() == 0 and got.where("filled <> value").count() == 0


def test_a_stamp_without_drivers_is_filled_by_time_of_day(spark):
    rows = [("A", T0 + i * HALF, None if i == 100 else 3.0) for i in range(48 * 4)]
    df = spark.createDataFrame(rows, "site string, t timestamp_ntz, value double").withColumn("var", F.lit("h"))
    drivers = spark.createDataFrame([], "site string, t timestamp_ntz, rg double, vpd double, ta double")
    r = gapfill.fill_series(df, drivers, ("var",)).where("value is null").first()
    assert r["filled"] == 3.0 and gapfill.STAGES[r["stage"] - 1][0] == ""


@pytest.mark.parametrize("compat", [False, True])
def test_scenario_columns(compat):
    assert tables.prune_scenario_columns(["NEE_U50_f", "NEE_U50_fqc", "Reco_U05", "NEE_uStar_f"]) == ["NEE_U50_f", "Reco_U05", "NEE_f"]
    assert tables.order_columns(["h_f", "a", "h"], {"h": "h_f"}) == ["a", "h", "h_f"]


def test_empty_tables(spark):
    df = series(spark, []).withColumns({"p_rain": F.lit(0.0), "slot": F.lit(0)})
    assert filters.quantile_filter(df, {"h": (0.01, 0.99)}).count() == 0
    assert filters.std_window_filter(df, {"h": (2.0, 10, 4)}).count() == 0
    assert filters.mad_hampel_filter(df, {"h": (5.5, 10)}).count() == 0
    assert timegrid.repair_time(df).count() == 0
