"""Readers on files written by hand, and the export of a station end to end."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stationflow.operators import calendar, filters, gapfill, partition, tables, timegrid, ustar
from stationflow.sources import sinks, station_files

T0 = dt.datetime(2022, 1, 1)
HALF = dt.timedelta(minutes=30)


def ias(path, start, n, value=1.0):
    rows = ["TIMESTAMP_START,TIMESTAMP_END,DTime,FC_1_1_1,VPD_PI_1_1_1"]
    rows += [f"{start + i * HALF:%Y%m%d%H%M},{start + (i + 1) * HALF:%Y%m%d%H%M},1,{value + i},20" for i in range(n)]
    path.write_text("\n".join(rows) + "\n")


def test_several_files_of_a_site_merge(spark, tmp_path):
    at = tmp_path / "site=tv"
    at.mkdir()
    ias(at / "tv_2022_1.csv", T0, 4)
    ias(at / "tv_2022_2.csv", T0 + 6 * HALF, 2, 9.0)
    ias(at / "tv_2024.csv", dt.datetime(2022, 1, 2), 1, 50.0)
    got = [r["value"] for r in station_files.read_layout(spark, str(tmp_path), "ias").where("var = 'co2_flux'").orderBy("t").collect()]
    assert got == [1.0, 2.0, 3.0, 4.0, None, None, 9.0, 10.0] + [None] * 40 + [50.0]
    assert {r["value"] for r in station_files.read_layout(spark, str(tmp_path), "ias").where("var = 'vpd'").collect()} == {2.0, None}


def test_bad_bytes_and_guessed_start(spark, tmp_path):
    (tmp_path / "site=Site_a").mkdir()
    (tmp_path / "site=Site_a" / "x.csv").write_bytes(b"station \xb0C\nmade,by\nTIMESTAMP,h,T\xb0\n2022-01-01 00:00,1.5,2\n2022-01-01 00:30,NAN,-9999\n")
    got = station_files.read_station_csv(spark, str(tmp_path), ["TIMESTAMP"], ["yyyy-M-d H:mm"], header=None, first=1)
    rows = {(r["site"], r["var"], r["t"]): r["value"] for r in got.collect()}
    assert rows == {("Site_a", "h", T0): 1.5, ("Site_a", "h", T0 + HALF): None, ("Site_a", "t\\xb0", T0): 2.0, ("Site_a", "t\\xb0", T0 + HALF): None}
    (tmp_path / "site=Site_a" / "y.csv").write_text("a\nb,c\nd\ne,f\ng\nh,i\nj\nk,l\nm\nn,o\n")
    with pytest.raises(Exception, match="No row of names found"):
        station_files.read_station_csv(spark, str(tmp_path), ["TIMESTAMP"], ["yyyy-M-d H:mm"], header=None, first=1).collect()


def test_broken_stamps_fail_loudly(spark, tmp_path):
    (tmp_path / "eddy pro tv_2023.csv").write_text("x,,,\nfilename,date,time,H\n,,,\nf,2023-01-01,00:00,1\nf,01-01-2023,00:30,2\n")
    assert station_files.read_layout(spark, str(tmp_path), "eddypro", strict=False).count() == 0
    with pytest.raises(Exception, match="None of date or time formats worked"):
        station_files.read_layout(spark, str(tmp_path), "eddypro").collect()


def test_biomet_joins_at_the_flux_step(spark, tmp_path):
    flux, met = tmp_path / "flux", tmp_path / "met"
    flux.mkdir(), met.mkdir()
    (flux / "Site_a_CSF_2022.csv").write_text("x\nTIMESTAMP,RECORD,FC,H\n,,,\n,,,\n" + "".join(f"{T0 + i * HALF:%Y-%m-%d %H:%M:%S},{i},{i},{i}\n" for i in range(4)))
    (met / "Site_a_2022.csv").write_text("TIMESTAMP_1,RH_1_1_1,H\n,\n" + "".join(f"{T0 + i * HALF / 3:%Y-%m-%d %H%M},{50 + i},7\n" for i in range(10)))
    both = station_files.merge_biomet(station_files.read_layout(spark, str(flux), "csf"), station_files.read_layout(spark, str(met), "biomet"))
    got = {}
    for r in both.orderBy("var", "t").collect():
        got.setdefault(r["var"], []).append(r["value"])
    assert got == {"co2_flux": [0.0, 1.0, 2.0, 3.0], "rh": [50.0, 53.0, 56.0, 59.0], "h": [7.0] * 4}


def test_a_station_from_files_to_level_3(spark, tmp_path):
    """Read, repair, filter, export, read back: what is rejected or missing is the code, all else the value read."""
    (tmp_path / "in").mkdir()
    values = [3.0, 99.0, None, 5.0, 6.0]
    rows = "".join(f"f,{T0 + (i + 1) * HALF:%Y-%m-%d,%H:%M},{-9999 if v is None else v},{i}\n" for i, v in enumerate(values))
    (tmp_path / "in" / "eddy pro tv_2022.csv").write_text("x,,,\nfilename,date,time,co2_flux,H\n,,,\n" + rows)
    long = station_files.read_layout(spark, str(tmp_path / "in"), "eddypro").withColumn("qc", F.lit(0))
    kept = filters.apply_flags(filters.collapse_flags(filters.min_max_filter(long, {"co2_flux": (-20.0, 20.0)}), ["f_minmax"]))
    wide = kept.groupBy("site", "t").pivot("var", ["co2_flux", "h"]).agg(F.first("filtered")).withColumnRenamed("co2_flux", "nee")
    wide = wide.withColumns({c: F.lit(1.0) for c in ("le", "swin", "ta", "rh", "vpd", "u_star")})
    assert timegrid.off_grid(wide).count() == 0
    table = sinks.level3(wide)
    sinks.write(table, str(tmp_path / "out"), ["site"], "csv", {"NEE": "umol_m-2_s-1"})
    back = spark.read.schema(table.schema).option("header", True).csv(str(tmp_path / "out")).orderBy("Hour").collect()
    assert [(r["Hour"], r["NEE"], r["H"]) for r in back] == [(0.5, 3.0, 0.0), (1.0, -9999.0, 1.0), (1.5, -9999.0, 2.0), (2.0, 5.0, 3.0), (2.5, 6.0, 4.0)]
    assert {r["site"] for r in back} == {"tv"} and spark.read.json(str(tmp_path / "out_units")).count() == 1


def test_fluxnet15_files_come_back(spark, tmp_path):
    rows = [("a", T0 + (i + 1) * HALF, None if i == 1 else float(i), 50.0, 1.5, 0.3) for i in range(4)]
    wide = spark.createDataFrame(rows, "site string, t timestamp_ntz, nee double, rh double, vpd double, u_star double")
    table = sinks.fluxnet15(wide)
    sinks.write(table, str(tmp_path / "out"), ["site"], "csv")
    first = table.orderBy("TIMESTAMP_END").first()
    assert (first["TIMESTAMP_START"], first["TIMESTAMP_END"], first["VPD_F_MDS"]) == ("202201010000", "202201010030", 15.0)
    got = {}
    for r in station_files.read_layout(spark, str(tmp_path / "out"), "fluxnet15").where("var <> 'year'").orderBy("var", "t").collect():
        assert r["site"] == "a"
        got.setdefault(r["var"], []).append((r["t"], r["value"]))
    at = [T0 + (i + 1) * HALF for i in range(4)]
    assert got["nee"] == list(zip(at, [0.0, None, 2.0, 3.0])) and got["vpd"] == [(t, 1.5) for t in at] and set(got) == {"nee", "rh", "vpd", "u_star"}


def test_a_station_from_level_3_to_level_4(spark):
    """Threshold, filter, gap filling, partitioning and daily sums of a made-up station give the respiration it was made with."""
    e0, rref, rows = 200, 3.0, []
    for i in range(60 * 48):
        hour, day = (i % 48) / 2, i // 48
        ta = 10 + 6 * math.sin((hour - 8) * math.pi / 12) + day / 10
        light = max(0.0, 600 * math.sin((hour - 6) * math.pi / 12))
        reco = rref * math.exp(e0 * (1 / 61.02 - 1 / (ta + 46.02)))
        u = 0.02 + 0.58 * ((i * 7919) % 1000) / 1000
        nee = None if i % 7 == 0 else (reco - 0.02 * light) * (0.3 if light < 10 and u < 0.15 else 1)
        rows.append(("a", "P", T0 + i * HALF, nee, light, ta, 0.5, u, reco))
    df = spark.createDataFrame(rows, "site string, season string, t timestamp_ntz, nee double, swin double, ta double, vpd double, u_star double, reco_true double")
    thresholds = ustar.yearly(ustar.threshold(df))
    assert 0.14 < thresholds.first()["ustar"] < 0.25
    filtered = ustar.ustar_filter(df, thresholds)
    fills = gapfill.mds_gap_fill(filtered.select("site", "t", F.col("nee_ustar").alias("value"), F.col("swin").alias("rg"), "vpd", "ta")).select("site", "t", "filled", "fqc")
    own = filtered.select("site", "t", "swin", "ta", "reco_true", F.col("nee_ustar").alias("nee")).join(fills, ["site", "t"])
    assert own.where("filled is null").count() == 0 and {r["fqc"] for r in own.select("fqc").distinct().collect()} <= {0, 1}
    fits = partition.partition_night(own)
    parts = partition.respiration(own, fits).where("reco is not null").withColumn("gpp_f", F.col("reco") - F.col("filled"))
    got = parts.agg(F.avg(F.abs(F.col("reco") - F.col("reco_true"))).alias("off"), F.avg("gpp_f").alias("gpp"), F.avg(F.col("swin") * 0.02).alias("want"), F.count("*").alias("n")).first()
    assert got["n"] > 50 * 48 and got["off"] < 0.2 and abs(got["gpp"] - got["want"]) < 0.2
    days = parts.groupBy(F.date_format("t", "yyyy-MM-dd").alias("date")).agg((F.avg(F.col("swin") * 0.02) * 48 * calendar.CARBON).alias("want"))
    sums = calendar.daily_sums(parts.select("site", F.lit("gpp").alias("var"), "t", F.col("gpp_f").alias("value"))).join(days, "date").collect()
    assert len(sums) == days.count() and all(abs(r["total"] - r["want"]) < 0.1 * r["want"] for r in sums)


def test_stray_stamps_of_a_file(spark, tmp_path):
    """One is left out, also where it is the first; more fail the job, or (not strict) leave the file out and the other files in."""
    def write(name, minutes):
        lines = ["TIMESTAMP_START,FC_1_1_1", *(f"20240101{m // 60:02d}{m % 60:02d},{i}" for i, m in enumerate(minutes))]
        (tmp_path / f"{name}_2024.csv").write_text("\n".join(lines))

    half = [30 * i for i in range(1, 20)]
    write("one", [17, *half])
    got = station_files.read_layout(spark, str(tmp_path), "ias")
    assert [r["value"] for r in got.orderBy("t").collect()] == [float(i) for i in range(1, 20)]
    write("two", [*half, 611, 641])
    with pytest.raises(Exception, match="can't be repaired"):
        station_files.read_layout(spark, str(tmp_path), "ias").collect()
    left = station_files.read_layout(spark, str(tmp_path), "ias", strict=False)
    assert left.where("value is not null").count() == 19


def biomet(path, start, n, step=HALF, names="TIMESTAMP_1,Ta_1_1_1,RH_1_1_1,H"):
    path.write_text(f"{names}\nyyyy-mm-dd HHMM,,,\n" + "".join(f"{start + i * step:%Y-%m-%d %H%M},{i},{50 + i},7\n" for i in range(n)))


def csf(path, start, n):
    path.write_text("TOA5,x\nTIMESTAMP,RECORD,FC,H\nTS,RN,umol,W\n,,,\n" + "".join(f'{start + i * HALF:%Y-%m-%d %H:%M:%S},{i},{i},{i}\n' for i in range(n)))


def series(df):
    got = {}
    for r in df.orderBy("site", "var", "t").collect():
        got.setdefault((r["site"], r["var"]), []).append(r["value"])
    return got


def test_a_folder_of_mixed_layouts(spark, tmp_path):
    """Logger files with weather files, full output, and an exchange file, each read by its own header; the weather files' H counts."""
    a, b, c = (tmp_path / f"site={x}" for x in "abc")
    a.mkdir(), b.mkdir(), c.mkdir()
    csf(a / "CSF_tv_fy4_2024.csv", T0, 4)
    biomet(a / "Biomet_tv_fy4_2023.csv", T0, 10, HALF / 3)
    (b / "eddy pro b_2022.csv").write_text("file_info,,,,\nfilename,date,time,co2_flux,u*\n,[yyyy-mm-dd],[HH:MM],[umol],\n" + "".join(f"f,{T0 + i * HALF:%d.%m.%Y,%H:%M},{i},0.5\n" for i in range(3)))
    ias(c / "c_2022_v01.csv", T0, 3)
    files = station_files.texts(spark, str(tmp_path))
    kinds = {r["file"]: (r["site"], r["layout"], r["mode"], r["problem"]) for r in station_files.known_files(files).collect()}
    assert kinds == {
        "site=a/CSF_tv_fy4_2024.csv": ("a", "csf", "CSF_AND_BIOMET", None), "site=a/Biomet_tv_fy4_2023.csv": ("a", "biomet", "CSF_AND_BIOMET", None),
        "site=b/eddy pro b_2022.csv": ("b", "eddypro", "EDDYPRO_FO", None), "site=c/c_2022_v01.csv": ("c", "ias", "IAS", None),
    }
    assert series(station_files.read_folder(spark, str(tmp_path))) == {
        ("a", "co2_flux"): [0.0, 1.0, 2.0, 3.0], ("a", "h"): [7.0] * 4, ("a", "rh"): [50.0, 53.0, 56.0, 59.0], ("a", "ta"): [0.0, 3.0, 6.0, 9.0],
        ("b", "co2_flux"): [0.0, 1.0, 2.0], ("b", "u_star"): [0.5] * 3, ("c", "co2_flux"): [1.0, 2.0, 3.0], ("c", "vpd"): [2.0] * 3,
    }


def test_folders_that_fit_no_import(spark, tmp_path):
    """Unknown files, weather alone, and two modes at a site are told; strict reading fails, else the rest is read."""
    csf(tmp_path / "s1_CSF_2024_a.csv", T0, 3)
    biomet(tmp_path / "weather.csv", T0, 3)
    (tmp_path / "notes.csv").write_text("hello,world\n1,2\n")
    (tmp_path / "blank.csv").write_text("\n\n")
    problems = lambda path, types=None: {r["file"]: (r["site"], r["problem"]) for r in station_files.known_files(station_files.texts(spark, str(path)), types).collect()}
    assert problems(tmp_path) == {"s1_CSF_2024_a.csv": ("s1", None), "weather.csv": ("s1", None), "notes.csv": ("unknown_site", "unknown layout"), "blank.csv": ("unknown_site", "unknown layout")}
    with pytest.raises(Exception, match="Can't import .*: unknown layout"):
        station_files.read_folder(spark, str(tmp_path)).collect()
    assert set(series(station_files.read_folder(spark, str(tmp_path), strict=False))) == {("s1", v) for v in ("co2_flux", "h", "ta", "rh")}
    met = tmp_path / "site=m"
    met.mkdir()
    biomet(met / "weather.csv", T0, 3)
    assert problems(met) == {"site=m/weather.csv": ("m", "no import mode")}
    two = tmp_path / "site=two"
    two.mkdir()
    csf(two / "a.csv", T0, 3)
    ias(two / "b.csv", T0, 3)
    assert {p for _, p in problems(two).values()} == {"several import modes"}
    assert {p for _, p in problems(two, {"a.csv": "ias"}).values()} == {None}


def test_a_header_row_of_two_kinds_is_unknown(spark):
    """Over half of the cells of one row, by one kind: two rows or kinds that fit are no answer; repeated cells count once."""
    rows = [("ias", "TIMESTAMP_START,FC_1_1_1,TA_9_1_1"), ("csf", "x\nTIMESTAMP,FC,FC,FC,nope"), (None, "TIMESTAMP,nope,nix"), (None, "TIMESTAMP,FC\nTIMESTAMP,FC"), ("biomet", "TIMESTAMP_1,RH_1_1_1"), (None, "filename,H,LE,VPD"), (None, "1\n2\n3\n4\nTIMESTAMP,FC"), (None, "")]
    df = spark.createDataFrame(rows, "want string, value string").select("want", station_files.file_layout(F.split("value", "\n")).alias("got"))
    assert [r["got"] for r in df.collect()] == [r["want"] for r in df.collect()]


def test_stamps_by_a_converter(spark, tmp_path):
    """Seconds since 1970 in two columns, days and seconds; a file that the converter can't read fails the job."""
    day = T0.toordinal() - dt.date(1970, 1, 1).toordinal()
    (tmp_path / "site=a").mkdir()
    (tmp_path / "site=a" / "x.csv").write_text("day,h,second\n" + "".join(f"{day},{i},{i * 1800}\n" for i in range(3)))
    convert = lambda text: F.timestamp_seconds(F.split(text, " ")[0].try_cast("long") * 86400 + F.split(text, " ")[1].try_cast("long"))
    read = lambda: station_files.read_station_csv(spark, str(tmp_path), ["day", "second"], converter=convert)
    assert [(r["var"], r["t"], r["value"]) for r in read().orderBy("t").collect()] == [("h", T0 + i * HALF, float(i)) for i in range(3)]
    (tmp_path / "site=a" / "y.csv").write_text("day,h,second\nnever,1,2\n")
    with pytest.raises(Exception, match="None of date or time formats worked"):
        read().collect()


def test_files_are_dealt_out_once(spark, tmp_path):
    """Up to the cells, the reader's one exchange is that of the files; the rest brings cells to their series."""
    ias(tmp_path / "c_2022_v01.csv", T0, 3)
    plan = station_files.read_layout(spark, str(tmp_path), "ias")._jdf.queryExecution().executedPlan().toString()
    keys = {line.split("hashpartitioning(")[1].split(",")[0].split("#")[0] for line in plan.splitlines() if "hashpartitioning(" in line}
    assert keys == {"file", "site"}
    assert all("hashpartitioning(file#" not in line or "REPARTITION_BY_COL" in line for line in plan.splitlines())


def test_a_file_for_each_site_and_interval(spark, tmp_path):
    """Names, units and rows, line by line; short months are left out; the label of all years."""
    rows = [("a", T0 + i * HALF, float(i) if i != 1 else None) for i in range(6)] + [("a", dt.datetime(2022, 2, 1), 9.0)] + [("b", dt.datetime(2023, 12, 31, 22) + i * HALF, i / 2) for i in range(10)]
    df = spark.createDataFrame(rows, "site string, t timestamp_ntz, h double")
    labels = lambda kind: {(r["site"], r["interval"]): r["count"] for r in timegrid.split_by_interval(df, kind).groupBy("site", "interval").count().collect()}
    assert labels("month") == {("a", "01.2022"): 6, ("b", "01.2024"): 6}
    assert labels("year") == {("a", "2022"): 7, ("b", "2024"): 6}
    assert labels("all") == {("a", "2022"): 7, ("b", "23-24"): 10}
    own = timegrid.split_by_interval(df, "month").select("site", "interval", F.date_format("t", "yyyyMMddHHmm").alias("t"), "h")
    sinks.write_tables(own, str(tmp_path / "out"), ["site", "interval"], ["t"], {"h": "W m-2"})
    files = sorted((tmp_path / "out").glob("site=*/interval=*/*.txt"))
    assert len(files) == 2
    assert files[0].read_text() == "t,h\n--,W m-2\n" + "".join(f"{T0 + i * HALF:%Y%m%d%H%M},{'-9999' if i == 1 else float(i)}\n" for i in range(6))
    assert files[1].read_text().splitlines()[:3] == ["t,h", "--,W m-2", "202401010000,2.0"]


def test_pairs_and_places_of_columns():
    assert calendar.pair_columns(["NEE", "NEE_f", "GPP_f", "H_ff"]) == {"NEE_f": "NEE", "GPP_f": None}
    with pytest.raises(ValueError, match="LE"):
        calendar.pair_columns(["NEE", "NEE_f", "LE_f"])
    assert tables.align_columns(["H_f", "U_f", "LE_f"], ["x", "LE_sqc", "H_sqc"], lambda c: c.replace("_sqc", "_f")) == ["H_f", "H_sqc", "U_f", "LE_f", "LE_sqc", "x"]
