"""Gap filling: short gaps by interpolation, then by the diurnal mean; long ones by marginal distribution sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut
from .filters import diurnal_mean


def interpolate_limit(df: DataFrame, limit: int = 3, value: str = "value", name: str = "filled") -> DataFrame:
    """Linear between neighbours for the first `limit` nulls of each gap; after the last value, that value; before the first, null. On the grid."""
    order = Window.partitionBy("site", "var").orderBy("t")
    # What follows is looked for from the end: frames that grow by one row are aggregated once, shrinking ones anew for each row.
    past, ahead = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("site", "var").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("_n", F.row_number().over(order))
    at = F.when(F.col(value).isNotNull(), F.col("_n"))
    own = own.withColumns({"_a": F.last(value, True).over(past), "_i": F.last(at, True).over(past), "_b": F.last(value, True).over(ahead), "_j": F.last(at, True).over(ahead)})
    line = F.col("_a") + (F.col("_b") - F.col("_a")) * ((F.col("_n") - F.col("_i")) / (F.col("_j") - F.col("_i")))
    gap = F.when(F.col("_n") - F.col("_i") <= limit, F.coalesce(line, F.col("_a")))
    return own.withColumn(name, F.coalesce(F.col(value), gap)).drop("_n", "_a", "_i", "_b", "_j")


def fill_diurnal(df: DataFrame, days: int = 10, least: int = 4, sentinel: float | None = -99999.0, limit: int = 3) -> DataFrame:
    """filled: interpolation, else the diurnal mean of the unfilled series, else the sentinel."""
    own = interpolate_limit(df, limit).withColumn("_m", diurnal_mean(F.col("value"), days, least))
    return own.withColumn("filled", F.coalesce("filled", "_m", F.lit(sentinel))).drop("_m")


#: Look-up steps in the order in which gaps try them: (drivers, days on each side). "" is the mean diurnal course (an hour around, same slot).
STAGES = (("all", 7), ("all", 14), ("rg", 7), ("", 0), ("", 1), ("", 2), ("all", 21), ("all", 28), ("rg", 14), ("rg", 21), ("rg", 28), ("", 7), ("", 14))


def mds_gap_fill(df: DataFrame, stages: Sequence[tuple[str, int]] = STAGES, rg: float = 50.0, vpd: float = 5.0, ta: float = 2.5, least: int = 2, narrow: int = 14) -> DataFrame:
    """Marginal distribution sampling: filled value, deviation, number of similar values, stage (0: measured) and quality class of every row.

    df: site, t, value, rg, vpd, ta. A gap takes the mean of the values of similar conditions within the first stage's days that gives
    `least` of them. The stages before the first of over `narrow` days run for all gaps, the others for what these leave. In each of the two rounds
    one equi-join by (site, day) serves all stages: a gap is dealt to the days of the widest, and every stage's sums are kept as one
    conditional aggregate, so each pair is formed once.
    """
    own = df.withColumns({"day": F.datediff(F.col("t").cast("date"), F.lit("1970-01-01").cast("date")), "minute": F.hour("t") * 60 + F.minute("t")})
    gaps = own.where("value is null").select("site", "t", "minute", F.col("rg").alias("g_rg"), F.col("vpd").alias("g_vpd"), F.col("ta").alias("g_ta"), "day")
    have = own.where("value is not null").select("site", F.col("day").alias("on"), F.col("minute").alias("m"), "value", "rg", "vpd", "ta")
    near = lambda c, tol: F.abs(F.col(c) - F.col(f"g_{c}")) < tol
    tests = {"all": near("rg", rg) & near("vpd", vpd) & near("ta", ta), "rg": near("rg", rg), "": F.abs(F.col("m") - F.col("minute")) <= 60}

    def look_up(gaps: DataFrame, own: list[tuple[int, str, int]]) -> DataFrame:
        widest = max(days for _, _, days in own)
        dealt = gaps.withColumn("off", F.explode(F.sequence(F.lit(-widest), F.lit(widest)))).withColumn("on", F.col("day") + F.col("off"))
        sums = []
        for i, kind, days in own:
            hit = F.when(tests[kind] & (F.abs("off") <= days), F.col("value"))
            sums += [F.count(hit).alias(f"n{i}"), F.avg(hit).alias(f"a{i}"), F.stddev_samp(hit).alias(f"s{i}")]
        got = dealt.join(have, ["site", "on"]).where(tests["rg"] | tests[""]).groupBy("site", "t").agg(*sums)
        first = lambda out: F.coalesce(*(F.when(F.col(f"n{i}") >= least, out(i)) for i, _, _ in own))
        return got.select("site", "t", first(lambda i: F.col(f"a{i}")).alias("mean"), first(lambda i: F.col(f"s{i}")).alias("fsd"), first(lambda i: F.col(f"n{i}")).alias("fnum"), first(lambda i: F.lit(i)).alias("stage")).where("stage is not null")

    numbered = [(i + 1, kind, days) for i, (kind, days) in enumerate(stages)]
    split = next((i for i, (_, _, days) in enumerate(numbered) if days > narrow), len(numbered))
    got = look_up(gaps, numbered[:split]) if split else None
    if split < len(numbered):
        left = gaps.join(got.select("site", "t"), ["site", "t"], "left_anti") if split else gaps
        wide = look_up(left, numbered[split:])
        got = got.unionByName(wide) if split else wide
    kind = F.create_map(*(x for i, k, d in numbered for x in (F.lit(i), F.lit(quality_class(k, d)))))
    both = df.join(got, ["site", "t"], "left")
    stage = F.when(F.col("value").isNotNull(), 0).otherwise(F.col("stage"))
    return both.select(*df.columns, F.coalesce("value", "mean").alias("filled"), F.when(F.col("value").isNull(), F.col("fsd")).alias("fsd"), F.when(F.col("value").isNull(), F.col("fnum")).alias("fnum"), stage.alias("stage"), F.when(stage == 0, 0).otherwise(kind[stage]).alias("fqc"))


def fill_series(series: DataFrame, drivers: DataFrame, by: Sequence[str] = ("var", "scenario"), uncertain: Column | None = None, stages: Sequence[tuple[str, int]] = STAGES, rg: float = 50.0, vpd: float = 5.0, ta: float = 2.5, least: int = 2) -> DataFrame:
    """Marginal distribution sampling of many series of a site at once: `by`, site, t, value and filled, fsd, fnum, stage, fqc of every row.

    series: site, t, `by`, value, unique by all but the last, with rows of null values where there are gaps. drivers: site, t, rg, vpd, ta.
    uncertain: for which series (a column of `by`) measured rows too get a deviation and number of similar values, as fluxes do; their value stays.
    Without it, only gaps are looked up, which is what saves the work for the weather variables.

    A stamp's gaps in all series are one row, and its values are one map, so a pair of stamps is formed and compared once for all variables and scenarios. A
    round joins only the days that its window adds to the last one's, for what is still open; number, sum and sum of squares of each ring of days are
    carried. The state is checkpointed between rounds. Rows without drivers are looked up by their time of day only.
    """
    series = series.withColumn("k", F.struct(*by))
    wanted = F.col("value").isNull() if uncertain is None else F.col("value").isNull() | uncertain
    stamps = series.groupBy("site", "t").agg(F.map_from_entries(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("k", "value")))).alias("have"), F.collect_list(F.when(wanted, F.col("k"))).alias("asked"))
    stamps = stamps.join(drivers.select("site", "t", "rg", "vpd", "ta"), ["site", "t"], "left").withColumns({"day": F.datediff(F.col("t").cast("date"), F.lit("1970-01-01").cast("date")), "minute": F.hour("t") * 60 + F.minute("t")})
    stamps = cut(stamps)
    have = stamps.where(F.size("have") > 0).select("site", F.col("day").alias("on"), F.col("minute").alias("m"), "have", "rg", "vpd", "ta")
    near = lambda c, tol: F.coalesce(F.abs(F.col(c) - F.col(f"g_{c}")) < tol, F.lit(False))
    tests = {"all": near("rg", rg) & near("vpd", vpd) & near("ta", ta), "rg": near("rg", rg), "": F.abs(F.col("m") - F.col("minute")) <= 60}
    numbered = [(i + 1, kind, days) for i, (kind, days) in enumerate(stages)]
    widths = {kind: sorted({d for _, k, d in numbered if k == kind}) for kind in tests}
    name = {"all": "a", "rg": "r", "": "m"}
    sums = [f"{x}{name[kind]}{w}" for kind in tests for w in widths[kind] for x in "nsq"]
    state = stamps.select("site", "t", F.explode("asked").alias("k")).select("*", *(F.lit(0.0).alias(c) for c in sums), F.lit(None).cast("int").alias("stage"))
    # A stage can be judged once all up to it can; a round ends where the next one in order needs a wider window.
    needs = [max(d for _, _, d in numbered[: n + 1]) for n in range(len(numbered))]
    ends = sorted(set(needs))
    done = -1
    for end in ends:
        left = state.where("stage is null") if done >= 0 else state
        gaps = left.groupBy("site", "t").agg(F.collect_list("k").alias("asked")).join(stamps.select("site", "t", "day", "minute", F.col("rg").alias("g_rg"), F.col("vpd").alias("g_vpd"), F.col("ta").alias("g_ta")), ["site", "t"])
        offsets = [o for o in range(-end, end + 1) if abs(o) > done]
        dealt = gaps.withColumn("off", F.explode(F.array(*map(F.lit, offsets)))).withColumn("on", F.col("day") + F.col("off"))
        pairs = dealt.join(have, ["site", "on"]).select("site", "t", "asked", "have", F.abs("off").alias("off"), *(t.alias(f"is_{name[k]}") for k, t in tests.items())).where("is_r or is_m")
        each = pairs.withColumn("k", F.explode("asked")).withColumn("v", F.col("have")[F.col("k")]).where("v is not null")
        aggs, rings = [], []
        for kind, own in widths.items():
            for lo, hi in zip([-1, *own], own):
                if hi > done and lo < end:
                    v = F.when(F.col(f"is_{name[kind]}") & (F.col("off") > lo) & (F.col("off") <= hi), F.col("v"))
                    aggs += [F.count(v).cast("double").alias(f"_n{name[kind]}{hi}"), F.sum(v).alias(f"_s{name[kind]}{hi}"), F.sum(v * v).alias(f"_q{name[kind]}{hi}")]
                    rings += [f"{x}{name[kind]}{hi}" for x in "nsq"]
        got = each.groupBy("site", "t", "k").agg(*aggs)
        state = state.join(got, ["site", "t", "k"], "left").withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0.0)) for c in rings}).select("site", "t", "k", *sums, "stage")
        ready = [n for n in range(len(numbered)) if needs[n] <= end]
        within = lambda kind, days, x: sum((F.col(f"{x}{name[kind]}{w}") for w in widths[kind] if w <= days), F.lit(0.0))
        hit = F.coalesce(*(F.when(within(numbered[n][1], numbered[n][2], "n") >= least, numbered[n][0]) for n in ready))
        state = cut(state.withColumn("stage", F.coalesce("stage", hit)))
        done = end
    pick = lambda x: F.coalesce(*(F.when(F.col("stage") == i, within(kind, days, x)) for i, kind, days in numbered))
    found = state.where("stage is not null").select("site", "t", "k", "stage", pick("n").alias("n"), pick("s").alias("s"), pick("q").alias("q"))
    found = found.select("site", "t", "k", "stage", (F.col("s") / F.col("n")).alias("mean"), F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1))).alias("fsd"), F.col("n").cast("long").alias("fnum"))
    kind = F.create_map(*(x for i, k, d in numbered for x in (F.lit(i), F.lit(quality_class(k, d)))))
    both = series.join(found, ["site", "t", "k"], "left")
    stage = F.when(F.col("value").isNotNull(), 0).otherwise(F.col("stage"))
    return both.select("site", *by, "t", "value", F.coalesce("value", "mean").alias("filled"), "fsd", "fnum", stage.alias("stage"), F.when(stage == 0, 0).otherwise(kind[stage]).alias("fqc"))


def quality_class(kind: str, days: int) -> int:
    """1 most reliable, 3 least, by drivers and window."""
    if kind == "all":
        return 1 if days <= 14 else 2 if days <= 28 else 3
    if kind == "rg":
        return 1 if days <= 14 else 2
    return 1 if days <= 1 else 2 if days <= 5 else 3


def keep_uncertainty(fsd: Column, wanted: Column) -> Column:
    """Deviations for the variables that want them (fluxes) only."""
    return F.when(wanted, fsd)


def nee_uncertainty(low: Column, high: Column, fsd: Column) -> tuple[Column, Column]:
    """The deviation over threshold scenarios (their 95 % span), and that combined with the filling's."""
    spread = (high - low) / (2 * 1.96)
    return spread, F.sqrt(fsd * fsd + spread * spread)
