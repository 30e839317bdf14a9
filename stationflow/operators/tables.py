"""Column names, cleaning, and checks of station files. Names are data: a header table has one row for each (file, pos, name)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUFFIX = r"_[0-9]+_[0-9]+_[0-9]+$"
#: Companions that a flux variable needs.
LINKED = {
    "FCH4": ("P", "RH", "SCH4", "USTAR", "CH4_RSSI"),
    "FC": ("FC_SSITC_TEST", "P", "RH", "SC", "SW_IN", "TA", "USTAR", "CO2_STR"),
    "H": ("G", "H_SSITC_TEST", "NETRAD", "P", "RH", "SH", "SW_IN"),
    "LE": ("LE_SSITC_TEST", "G", "NETRAD", "P", "SLE", "SW_IN", "H2O_STR"),
    "TAU": ("TAU_SSITC_TEST",),
}
#: Missing-value codes on disk.
MISSING = ("-9999", "-9999.0", "NAN", "NaN")


def invert(names: Mapping[str, str]) -> dict[str, str]:
    out = {v: k for k, v in names.items()}
    if len(out) < len(names):
        raise ValueError("two names map to one")
    return out


def rename_vocabulary(df: DataFrame, names: Mapping[str, str], column: str = "var") -> DataFrame:
    """Values of a name column by the vocabulary, in lower case."""
    table = df.sparkSession.createDataFrame(list(names.items()), "_from string, _to string")
    return df.join(F.broadcast(table), F.col(column) == F.col("_from"), "left").withColumn(column, F.lower(F.coalesce("_to", F.col(column)))).drop("_from", "_to")


def rename_regex(name: Column, patterns: Mapping[str, str]) -> Column:
    """The last pattern that matches the head of the name wins."""
    out = name
    for pattern, to in patterns.items():
        out = F.when(name.rlike(f"^(?:{pattern})"), to).otherwise(out)
    return out


def normalise_case(df: DataFrame, canonical: Iterable[str], column: str = "name") -> DataFrame:
    """df with `fixed`: the canonical spelling, or null for unknown names."""
    table = df.sparkSession.createDataFrame([(c.lower(), c) for c in canonical], "_low string, fixed string")
    return df.join(F.broadcast(table), F.lower(column) == F.col("_low"), "left").drop("_low")


def verify_columns(headers: DataFrame, mandatory: Iterable[str], known: Iterable[str]) -> DataFrame:
    """file, name, problem: mandatory names that a file lacks, and names outside the vocabulary."""
    one = lambda names: headers.sparkSession.createDataFrame([(n,) for n in names], "name string")
    wanted = headers.select("file").distinct().crossJoin(F.broadcast(one(mandatory)))  # a few constant names for each file
    missing = wanted.join(headers.select("file", "name"), ["file", "name"], "left_anti").withColumn("problem", F.lit("missing"))
    unknown = headers.select("file", "name").join(F.broadcast(one(known)), "name", "left_anti").select("file", "name").withColumn("problem", F.lit("unknown"))
    return missing.unionByName(unknown)


def station_name(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low == "u*", "u_star").when(low.contains("co2_signal_strength") | (low == "co2ss"), "co2_signal_strength")
        .when(low.contains("ch4_signal_strength") | (low == "ch4ss"), "ch4_signal_strength").when(low.startswith("ppfd_in"), F.regexp_replace(low, "^ppfd_in", "ppfd"))
        .when(low.startswith("sw_in"), F.regexp_replace(low, "^sw_in", "swin")).otherwise(low)
    )


def prune_scenario_columns(columns: Sequence[str]) -> list[str]:
    """Without bootstrap columns but for *_f, Reco_* and GPP_*; `_uStar` goes from the names."""
    kept = [c for c in columns if not re.search(r"_U\d\d", c) or c.endswith("_f") or c.startswith(("Reco_", "GPP_"))]
    return [c.replace("_uStar", "") for c in kept]


def order_columns(columns: Sequence[str], pairs: Mapping[str, str] | None = None) -> list[str]:
    """Sorted with `_` as a blank; each paired column right after its partner."""
    out = sorted(columns, key=lambda c: c.replace("_", " "))
    for a, b in (pairs or {}).items():
        if a in out and b in out:
            out.remove(b)
            out.insert(out.index(a) + 1, b)
    return out


def align_columns(columns: Sequence[str], added: Sequence[str], rule: Callable[[str], str | None]) -> list[str]:
    """columns and the added ones, each right after the column that the rule names for it (several in the order given), or at the end where the rule names none that is there."""
    after: dict[str, list[str]] = {}
    for c in added:
        place = rule(c)
        after.setdefault(place if place in columns else "", []).append(c)
    return [x for c in columns for x in (c, *after.get(c, []))] + after.get("", [])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def null_codes(text: Column, codes: Sequence[str] = MISSING) -> Column:
    """Text to double; codes, other text and NaN become null."""
    number = F.when(~F.trim(text).isin(*codes), text).try_cast("double")
    return F.when(~F.isnan(number), number)


def non_numeric(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    return df.where(F.col(text).isNotNull() & F.col(text).try_cast("double").isNull()).select(*keys, text)


def drop_empty(df: DataFrame) -> DataFrame:
    """Without variables that have no value at a site."""
    some = df.where("value is not null").select("site", "var").distinct()
    return df.join(some, ["site", "var"], "left_semi")


def filter_long_runs(df: DataFrame, least: int = 8, name: str = "value_runs") -> DataFrame:
    """Null where a value repeats for `least` rows or more in a row."""
    order = Window.partitionBy("site", "var").orderBy("t")
    new = (~F.col("value").eqNullSafe(F.lag("value").over(order))).cast("int")
    own = df.withColumn("_run", F.sum(new).over(order))
    n = F.count("*").over(Window.partitionBy("site", "var", "_run"))
    return own.withColumn("_n", n).withColumn(name, F.when(F.col("_n") < least, F.col("value"))).drop("_run", "_n")


def equal_columns(a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """name, same: are the columns equal over the common keys, null as null?"""
    both = a.select(*key, *(F.col(c).alias(f"_a_{c}") for c in columns)).join(b.select(*key, *columns), list(key))
    got = both.agg(*(F.coalesce(F.bool_and(F.col(f"_a_{c}").eqNullSafe(F.col(c))), F.lit(True)).alias(c) for c in columns))
    return got.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("same")) for c in columns))).alias("x")).select("x.*")


def detect_file_type(cells: DataFrame, vocabularies: DataFrame, share: float = 0.5) -> DataFrame:
    """file, type: of the cells (file, row, cell) of the first rows, the one (row, vocabulary) whose share of known cells is over `share`; else UNKNOWN."""
    own = cells.where("cell is not null and cell <> ''")
    total = own.groupBy("file", "row").agg(F.count("*").alias("n"))
    hits = own.join(F.broadcast(vocabularies), F.col("cell") == F.col("name")).groupBy("file", "row", "type").agg(F.count("*").alias("k"))
    good = hits.join(total, ["file", "row"]).where(F.col("k") / F.col("n") > share)
    one = good.groupBy("file").agg(F.count("*").alias("n"), F.min("type").alias("type"))
    return cells.select("file").distinct().join(one, "file", "left").select("file", F.when(F.col("n") == 1, F.col("type")).otherwise("UNKNOWN").alias("type"))


def detect_import_mode(types: DataFrame) -> DataFrame:
    """site, mode: by the set of a site's file types; null for none or several."""
    got = types.groupBy("site").agg(F.collect_set("type").alias("s"))
    has = lambda t: F.array_contains("s", t)
    meteo = has("EDDYPRO_BIOMET")
    modes = F.array_compact(F.array(F.when(has("EDDYPRO_FO"), F.when(meteo, "EDDYPRO_FO_AND_BIOMET").otherwise("EDDYPRO_FO")), F.when(has("IAS"), F.lit("IAS")), F.when(has("CSF"), F.when(meteo, "CSF_AND_BIOMET").otherwise("CSF"))))
    return got.select("site", F.when(F.size(modes) == 1, F.get(modes, F.lit(0))).alias("mode"))


def site_from_name(name: Column) -> tuple[Column, Column]:
    """Site and version, by the naming habits of the file kinds."""
    own = F.regexp_replace(name, " ", "_")
    tries = [r"(?i)^(.*)_[0-9]{2,4}_(v[0-9N]{1,3})", r"(?i)^(.*)_CSF_[0-9]{2,4}_.*", r"(?i)^(.*)_FO_.*[0-9]{2,4}", r"(?i)^eddy.?pro_(.*)_[0-9]{2,4}"]
    found = [F.when(own.rlike(p), F.regexp_extract(own, p, 1)) for p in tries]
    return F.coalesce(*found, F.lit("unknown_site")), F.when(own.rlike(tries[0]), F.regexp_extract(own, tries[0], 2))


def header_lint(headers: DataFrame, known: Iterable[str]) -> DataFrame:
    """file, name, problem: misplaced time columns, duplicates, bad suffixes, index gaps, unknown names."""
    names = headers.sparkSession.createDataFrame([(n,) for n in known], "_known string")
    stem = F.regexp_replace("name", SUFFIX, "")
    time = F.col("name").isin("TIMESTAMP_START", "TIMESTAMP_END", "DTime")
    order = F.when(F.col("name") == "TIMESTAMP_START", 0).when(F.col("name") == "TIMESTAMP_END", 1).when(F.col("name") == "DTime", 2)
    problem = lambda df, text: df.select("file", "name", F.lit(text).alias("problem"))
    data = headers.where(~time).withColumn("stem", stem)
    first = F.regexp_extract("name", r"_([0-9]+)_[0-9]+_[0-9]+$", 1).try_cast("int")
    index = data.where(F.col("name").rlike(SUFFIX)).withColumn("i", first)
    gaps = index.select("file", "stem", "i", "name").distinct().withColumn("before", F.lag("i", 1, 0).over(Window.partitionBy("file", "stem").orderBy("i", "name")))
    parts = [
        problem(headers.where(time & (F.col("pos") != order)), "time column misplaced"),
        problem(headers.groupBy("file", "name").count().where("count > 1"), "duplicate"),
        problem(data.where(~F.col("name").rlike(SUFFIX)), "bad suffix"),
        problem(gaps.where("i - before > 1"), "index gap"),
        problem(data.join(F.broadcast(names), F.col("stem") == F.col("_known"), "left_anti"), "unknown"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def linked_columns(headers: DataFrame, linked: Mapping[str, Sequence[str]] = LINKED) -> DataFrame:
    """file, var, missing: companions that a file with the variable lacks."""
    rules = headers.sparkSession.createDataFrame([(v, c) for v, cs in linked.items() for c in cs], "var string, missing string")
    stems = headers.select("file", F.regexp_replace("name", SUFFIX, "").alias("stem")).distinct()
    wanted = stems.join(F.broadcast(rules), F.col("stem") == F.col("var")).select("file", "var", "missing")
    return wanted.join(stems.withColumnRenamed("stem", "missing"), ["file", "missing"], "left_anti").select("file", "var", "missing")


def time_column_check(df: DataFrame, text: str, fmt: str, by: str = "file") -> DataFrame:
    """by, unparsed, years (the last stamp left out), duplicates."""
    own = df.withColumn("_t", F.try_to_timestamp(F.col(text), F.lit(fmt)))
    last = F.max("_t").over(Window.partitionBy(by))
    own = own.withColumn("_year", F.when(F.col("_t") < last, F.year("_t")))
    once = own.groupBy(by, "_t").agg(F.count("*").alias("n"), F.first("_year").alias("y")).groupBy(by)
    return once.agg(F.sum(F.when(F.col("_t").isNull(), F.col("n")).otherwise(0)).alias("unparsed"), F.count_distinct("y").alias("years"), F.sum(F.when(F.col("_t").isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicates"))


def value_check(df: DataFrame, text: str = "raw", by: Sequence[str] = ("site", "var")) -> DataFrame:
    """by, n, empty, coded, infinite, not_numeric: what a column of raw text holds."""
    number = F.col(text).try_cast("double")
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(text).isNull() | (F.trim(text) == "")).alias("empty"), F.count_if(F.trim(text).isin(*MISSING)).alias("coded"), F.count_if(F.abs(number) == float("inf")).alias("infinite"), F.count_if(F.col(text).isNotNull() & (F.trim(text) != "") & ~F.trim(text).isin(*MISSING) & number.isNull()).alias("not_numeric"))


def unknown_and_unused(headers: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """file, name, problem. vocabulary: name, used."""
    both = headers.join(F.broadcast(vocabulary), "name", "left")
    return both.where("used is null or not used").select("file", "name", F.when(F.col("used").isNull(), "unknown").otherwise("unused").alias("problem"))


def error_total(*reports: DataFrame) -> DataFrame:
    """check, errors: rows of each report, by its place."""
    out = None
    for i, r in enumerate(reports):
        part = r.agg(F.count("*").alias("errors")).select(F.lit(i).alias("check"), "errors")
        out = part if out is None else out.unionByName(part)
    return out
