"""Readers of station files.

A file is one row until its lines are told apart: its kind, names, first row of data and format of stamps are found there, so no cell is joined with its column's name.
Files are dealt out once by their name; what is judged file by file needs no other exchange. A station file is a year at most, so small.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.tables import detect_import_mode, null_codes, site_from_name
from ..operators.timegrid import on_grid, repair_time, series_verdicts, usual_step
from .layouts import IN_HPA, LAYOUTS, NO_VARIABLES, SIGNATURES, TYPES, Layout, Signature


@F.pandas_udf(StringType())
def escaped(content: pd.Series) -> pd.Series:
    """UTF-8 text with the bytes that are none written as \\xNN. Only broken files come here."""
    return content.map(lambda b: bytes(b).decode("utf-8", "backslashreplace"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """file (with its site= folder), folder, value (the whole text; empty files give no row). Whole files, because Spark keeps no line numbers otherwise."""
    own = r"((site=[^/]*/)?[^/]*)$"
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", own, 1).alias("file"), F.regexp_replace("path", own, "").alias("folder"), "content")
    sound = F.is_valid_utf8(F.col("content").cast("string"))
    whole = files.where(sound).select("file", "folder", F.col("content").cast("string").alias("value")).unionByName(files.where(~sound).select("file", "folder", escaped("content").alias("value")))
    return whole.withColumn("value", F.regexp_replace("value", "\r", ""))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, row (exact line number), line."""
    return texts(spark, path).select("file", F.posexplode(F.split("value", "\n")).alias("row", "line")).where("line <> ''")


def table_start(rows: Column, look: int = 10, separator: str = ",") -> Column:
    """The first row after which the number of fields stays the same over the first rows of a file (an array of its lines); null if it changes at the last one."""
    head = F.filter(F.transform(F.slice(rows, 1, look), lambda line, i: F.struct(i.alias("row"), line.alias("line"), F.size(F.split(line, separator)).alias("n"))), lambda x: x["line"] != "")
    changed = F.filter(head, lambda x, i: (i > 0) & (x["n"] != F.get(head, i - 1)["n"]))
    start, last = F.coalesce(F.try_element_at(changed, F.lit(-1))["row"], F.lit(0)), F.try_element_at(head, F.lit(-1))["row"]
    return F.when((start < last) | (last == 0), start)


def guess_table_start(files: DataFrame, look: int = 10, separator: str = ",") -> DataFrame:
    """file, start of every file (file, value)."""
    return files.select("file", table_start(F.split("value", "\n"), look, separator).alias("start"))


def file_layout(rows: Column, signatures: Mapping[str, Signature] = SIGNATURES, look: int = 4, share: float = 0.5, separator: str = ",") -> Column:
    """The layout whose signature holds over `share` of the distinct cells of one of a file's first rows; null where no pair of row and layout does, or several do."""
    head = F.filter(F.slice(rows, 1, look), lambda line: line != "")
    cells = F.transform(head, lambda line: F.array_distinct(F.filter(F.transform(F.split(line, separator), lambda c: F.trim(c)), lambda c: c != "")))

    def is_of(s: Signature) -> Callable[[Column], Column]:
        return lambda c: c.isin(*s.names) | (c.rlike(s.pattern) & ~c.isin(*s.excepted)) if s.pattern else c.isin(*s.names)

    found = F.flatten(F.transform(cells, lambda row: F.array_compact(F.array(*(F.when(F.size(F.filter(row, is_of(s))) > share * F.size(row), k) for k, s in signatures.items())))))
    return F.get(F.filter(F.array(found), lambda f: F.size(f) == 1), F.lit(0))[0]


def site_of(file: Column) -> Column:
    """The partition folder's site, else what the file name says."""
    folder = F.regexp_extract(file, "^site=([^/]*)/", 1)
    return F.when(folder != "", folder).otherwise(site_from_name(F.regexp_replace(file, "^.*/", ""))[0])


def _specs(layouts: Mapping[str, Layout]) -> Column:
    """What a row's layout says, as one struct, so that the readers' expressions do not multiply with the layouts."""
    def spec(x: Layout) -> Column:
        names = F.create_map(*(F.lit(v) for pair in x.names.items() for v in pair)) if x.names else F.create_map().cast("map<string,string>")
        return F.struct(F.array(*map(F.lit, x.stamps)).alias("stamps"), F.lit(x.header).cast("int").alias("header"), F.lit(x.first).alias("first"), names.alias("names"), F.lit(x.separator).alias("separator"))

    return F.coalesce(*(F.when(F.col("layout") == k, spec(x)) for k, x in layouts.items()))


def _cells(line: Column | str) -> Column:
    return F.transform(F.split(line, F.col("spec.separator")), lambda c: F.trim(c))


def _tables(files: DataFrame, layouts: Mapping[str, Layout], converter: Callable[[Column], Column] | None = None) -> DataFrame:
    """files (file, layout, covered, value and others) with spec, names (of the columns, by the vocabulary; null for those of the stamp and the covered ones), lines (row, line, stamp of the data rows) and parser.

    parser: the place of the one parser (a converter, or a format of the layout) that makes something of every stamp of the file; null where none or several do.
    """
    own = files.withColumn("spec", _specs(layouts)).withColumn("rows", F.split("value", "\n")).drop("value")
    if any(x.header is None for x in layouts.values()):
        failed = F.raise_error(F.concat(F.lit("No row of names found, numbers of fields differ to the last row looked at: "), F.col("file"))).cast("int")
        start = F.when(F.col("spec.header").isNotNull(), 0).otherwise(F.coalesce(*(F.when(F.col("layout") == k, table_start(F.col("rows"), separator=x.separator)) for k, x in layouts.items() if x.header is None), failed))
    else:
        start = F.lit(0)
    own = own.withColumn("start", start)
    own = own.withColumn("raw_names", _cells(F.get("rows", F.col("start") + F.coalesce("spec.header", F.lit(0)))))
    own = own.withColumn("places", F.transform("spec.stamps", lambda s: F.array_position("raw_names", s)))
    known = F.transform("raw_names", lambda n: F.lower(F.coalesce(F.try_element_at("spec.names", n), n)))
    names = F.transform(known, lambda n, i: F.when(~F.array_contains("places", (i + 1).cast("bigint")) & ~F.array_contains("covered", n), n))
    data = F.filter(F.transform("rows", lambda line, i: F.struct(i.alias("row"), line.alias("line"))), lambda r: (r["row"] >= F.col("start") + F.col("spec.first")) & (r["line"] != ""))
    stamp = lambda line: F.array_join(F.transform("places", lambda p: F.trim(F.get(F.split(line, F.col("spec.separator")), p.cast("int") - 1))), " ")
    own = own.withColumn("names", names).withColumn("lines", F.transform(data, lambda r: F.struct(r["row"].alias("row"), r["line"].alias("line"), stamp(r["line"]).alias("stamp"))))
    all_of = lambda parse: F.forall("lines", lambda r: parse(r["stamp"]).isNotNull())
    fits = F.array_compact(F.array(*(F.when(used & all_of(parse), F.lit(i)) for i, (used, parse) in enumerate(_parsers(layouts, converter)))))
    return own.withColumn("fits", fits).withColumn("parser", F.when(F.size("fits") == 1, F.get("fits", F.lit(0)))).drop("rows", "raw_names", "places", "start", "fits")


def _parsers(layouts: Mapping[str, Layout], converter: Callable[[Column], Column] | None) -> list[tuple[Column, Callable[[Column], Column]]]:
    """For each converter of stamps, the files it is for and what it does."""
    if converter:
        return [(F.lit(True), lambda text: converter(text).cast("timestamp_ntz"))]
    formats = dict.fromkeys(f for x in layouts.values() for f in x.formats)
    parse = lambda f: lambda text: F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz")
    return [(F.col("layout").isin(*(k for k, x in layouts.items() if f in x.formats)), parse(f)) for f in formats]


def _series(files: DataFrame, layouts: Mapping[str, Layout], converter: Callable[[Column], Column] | None, step: str | None, strict: bool, least: int) -> DataFrame:
    """site, t, var, value, layout of files (file, site, layout, covered, value), but for the variables in covered. See read_station_csv()."""
    parsers = _parsers(layouts, converter)
    own = _tables(files, layouts, converter)
    rows = own.select("file", "site", "layout", "spec", "names", "parser", F.explode_outer("lines").alias("x")).where("x is not null")  # outer: Spark would repeat all the work above to leave out files without lines early
    rows = rows.withColumn("t", F.coalesce(*(F.when(F.col("parser") == i, parse(F.col("x.stamp"))) for i, (_, parse) in enumerate(parsers)))).select("file", "site", "layout", F.col("spec.separator").alias("separator"), "names", "x.row", "x.line", "t")
    if strict:
        rows = rows.withColumn("t", F.coalesce("t", F.raise_error(F.concat(F.lit("None of date or time formats worked: "), F.col("file"))).cast("timestamp_ntz")))
    if step:
        seconds = round(pd.Timedelta(step.lower()).total_seconds())
        stamps = rows.select("file", "t")
        stamps = stamps.join(usual_step(stamps, ("file",), "every"), "file", "left").withColumn("every", F.least(F.col("every"), F.lit(seconds)))  # a file may be finer than the step, or full of holes
        rows = on_grid(rows, series_verdicts(stamps, "every", ("file", "every"), least), "every", ("file",), strict)
    raw = F.split("line", F.col("separator"))
    named = F.transform(raw, lambda cell, i: F.struct(F.get("names", i).alias("name"), cell.alias("raw")))
    long = rows.select("file", "site", "layout", "row", "t", F.posexplode_outer(named).alias("pos", "cell")).where("cell.name is not null")
    long = long.select("site", "t", F.col("cell.name").alias("var"), null_codes(F.trim("cell.raw")).alias("value"), "layout", "file", "row", "pos")
    got = repair_time(long, step or "30 MINUTES", ("site", "var"), ("file", "row", "pos"), fill_gaps=step is not None)
    return got.select("site", "t", "var", "value", "layout")


def read_station_csv(spark: SparkSession, path: str, stamps: Sequence[str], formats: Sequence[str] = (), header: int | None = 0, first: int = 1, names: Mapping[str, str] | None = None, separator: str = ",", step: str | None = "30 MINUTES", strict: bool = True, least: int = 0, converter: Callable[[Column], Column] | None = None) -> DataFrame:
    """site, t, var, value of all files at the path. stamps: the columns whose texts, joined by a blank, are the time stamp; a converter makes it a time, in place of the formats.

    A file whose stamps no single format (or the converter) parses, with more than one stamp off its grid (of the step, or its own finer one), or with under `least` rows fails the job.
    Not strict: such files give no row, and a caller finds them by the verdicts of timegrid. One stamp off the grid is left out.
    Without a header row, each file's table starts where its rows begin to have equal numbers of fields, and `first` counts from there.

    Missing codes become null, names go by the vocabulary, duplicate stamps keep the first by file, row and column, and with a step each series is completed.
    """
    layout = Layout(stamps, formats, header, first, names or {}, separator)
    files = texts(spark, path).repartition("file").select("file", site_of(F.col("file")).alias("site"), F.lit("own").alias("layout"), F.array().cast("array<string>").alias("covered"), "value")
    return _series(files, {"own": layout}, converter, step, strict, least).drop("layout")


def merge_biomet(flux: DataFrame, biomet: DataFrame) -> DataFrame:
    """Flux and weather series (site, t, var, value) together. Of a site's variables in both, the weather file's count. Read both at the flux step."""
    theirs = biomet.select("site", "var").distinct()
    return flux.join(theirs, ["site", "var"], "left_anti").unionByName(biomet)


def in_kpa(df: DataFrame) -> DataFrame:
    """Series (var, value, layout) without the columns that are no variables; vapour pressure deficits in hPa become kPa."""
    got = df.where(~F.col("var").isin(*NO_VARIABLES))
    return got.withColumn("value", F.when((F.col("var") == "vpd") & F.col("layout").isin(*IN_HPA), F.col("value") * 0.1).otherwise(F.col("value")))


def read_layout(spark: SparkSession, path: str, layout: str, step: str | None = "30 MINUTES", strict: bool = True) -> DataFrame:
    """site, t, var, value of files of one layout; vapour pressure deficits in hPa become kPa."""
    got = read_station_csv(spark, path, *LAYOUTS[layout], step, strict)
    return in_kpa(got.withColumn("layout", F.lit(layout))).drop("layout")


def known_files(files: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """file, site, layout, mode, problem, covered of files (file, folder, value); types: layouts by file name, where the header rows are not to decide.

    A weather file whose own name (or folder) names no site belongs to the one site of the flux files beside it.
    mode: what the site's files are together; problem: `unknown layout`, `no import mode`, `several import modes` (at the file's site), or null.
    covered: for a flux file, the variables that the site's weather files have (their column counts); empty for a weather file.
    """
    given = F.coalesce(*(F.when(F.regexp_replace("file", "^.*/", "") == name, F.lit(kind)) for name, kind in types.items())) if types else F.lit(None).cast("string")
    rows = F.split("value", "\n")
    own = files.select("file", "folder", F.coalesce(given, file_layout(rows)).alias("layout"), F.when(site_of(F.col("file")) != "unknown_site", site_of(F.col("file"))).alias("named"), F.get(rows, F.lit(LAYOUTS["biomet"].header)).alias("head"))
    weather = F.col("layout") == "biomet"
    table = F.create_map(*(F.lit(v) for pair in LAYOUTS["biomet"].names.items() for v in pair))
    theirs = F.transform(F.split("head", LAYOUTS["biomet"].separator), lambda n: F.lower(F.coalesce(F.try_element_at(table, F.trim(n)), F.trim(n))))
    beside = F.collect_set(F.when(F.col("layout").isNotNull() & ~weather, F.coalesce("named", F.lit("unknown_site")))).over(Window.partitionBy("folder"))
    only = F.when(F.size(beside) == 1, F.get(beside, F.lit(0)))
    own = own.select("file", "layout", F.coalesce("named", F.when(weather, only), F.lit("unknown_site")).alias("site"), F.when(weather, theirs).alias("theirs"))
    sites = own.groupBy("site").agg(F.array_distinct(F.flatten(F.collect_set("theirs"))).alias("weather"), F.size(F.collect_set(F.when(F.col("layout") != "biomet", F.col("layout")))).alias("kinds"))
    modes = detect_import_mode(own.select("site", F.coalesce(*(F.when(F.col("layout") == k, v) for k, v in TYPES.items()), F.lit("UNKNOWN")).alias("type")))
    got = own.join(sites, "site").join(modes, "site")
    problem = F.when(F.col("layout").isNull(), "unknown layout").when(F.col("kinds") == 0, "no import mode").when(F.col("mode").isNull(), "several import modes")
    covered = F.when(F.col("layout") != "biomet", F.col("weather")).otherwise(F.array().cast("array<string>"))
    return got.select("file", "site", "layout", "mode", problem.alias("problem"), covered.alias("covered"))


def read_folder(spark: SparkSession, path: str, step: str = "30 MINUTES", strict: bool = True, types: Mapping[str, str] | None = None) -> DataFrame:
    """site, t, var, value of a folder of files of any layout, each read by its own, in one plan. Of a site's variables in flux and weather files, the weather files' count.

    A file of no layout, or a site whose files fit no import mode or several, fails the job. Not strict: they are left out, and known_files() lists them.
    """
    files = texts(spark, path).repartition("file")
    kinds = known_files(files, types)
    said = F.concat(F.lit("Can't import "), F.col("file"), F.lit(": "), F.col("problem"))
    sound = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean") if strict else F.lit(False))
    own = files.join(kinds, "file").where(sound)
    got = _series(own.select("file", "site", "layout", "covered", "value"), {k: LAYOUTS[k] for k in TYPES}, None, step, strict, 0)
    return in_kpa(got).select("site", "t", "var", "value")


def read_level3(spark: SparkSession, path: str) -> DataFrame:
    """file, t and the columns of level-3 text (blank-separated, names and units in two rows); -9999 is null."""
    columns = ("Year", "DoY", "Hour", "NEE", "LE", "H", "Rg", "Tair", "Tsoil", "rH", "VPD", "Ustar", "CH4flux")
    rows = F.split("value", "\n")
    own = texts(spark, path).select("file", F.transform(F.split(F.get(rows, F.lit(0)), " "), lambda c: F.trim(c)).alias("names"), F.explode(F.slice(rows, 3, F.greatest(F.size(rows) - 2, F.lit(0)))).alias("line")).where("line <> ''")
    own = own.select("file", "names", F.split("line", " ").alias("cells"))
    wide = own.select("file", *(F.trim(F.get("cells", F.array_position("names", F.lit(c)).cast("int") - 1)).alias(c) for c in columns))
    day = F.date_add(F.make_date(F.col("Year").try_cast("int"), F.lit(1), F.lit(1)), F.col("DoY").try_cast("int") - 1)
    t = (F.unix_seconds(day.cast("timestamp")) + (F.col("Hour").try_cast("double") * 3600).cast("long")).cast("timestamp").cast("timestamp_ntz")
    return wide.select("file", t.alias("t"), *(null_codes(F.col(c)).alias(c) for c in columns[3:]))
