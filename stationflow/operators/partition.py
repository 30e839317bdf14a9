"""Net exchange split into respiration and uptake."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut

#: Fixed values of the respiration model: reference and zero temperatures in degrees C.
T_REF, T_ZERO = 15.0, -46.02
BLOCK = 17


def day_number() -> Column:
    return F.datediff(F.col("t").cast("date"), F.lit("1970-01-01").cast("date"))


def windows_of(days: int, every: int) -> Column:
    """The numbers w of the windows, from day w * every on, that a row is in."""
    return F.sequence(F.ceil((day_number() - days + 1) / every).cast("int"), F.floor(day_number() / every).cast("int"))


def temperature_response(ta: Column, e0: Column) -> Column:
    return F.exp(e0 * (F.lit(1.0) / (T_REF - T_ZERO) - F.lit(1.0) / (ta - T_ZERO)))


def _window_sums(df: DataFrame, e0: tuple[int, ...], days: int, every: int, dark: float) -> tuple[DataFrame, list[Column]]:
    """site, w, es (a block of E0), n, yy and for each E0 of the block yg and gg; and the block's E0 as columns."""
    night = df.where((F.col("swin") < dark) & F.col("nee").isNotNull() & F.col("ta").isNotNull() & (F.col("ta") > T_ZERO + 1))
    blocks = [e0[i : i + BLOCK] for i in range(0, len(e0), BLOCK)]
    own = night.select("site", "nee", "ta", F.explode(windows_of(days, every)).alias("w")).withColumn("es", F.explode(F.array(*(F.array(*map(F.lit, b)) for b in blocks))))
    at = [F.get("es", F.lit(i)) for i in range(len(blocks[0]))]
    g = [temperature_response(F.col("ta"), e.cast("double")) for e in at]
    sums = own.groupBy("site", "w", "es").agg(
        F.sum(F.col("nee") * F.col("nee")).alias("yy"), F.count("*").alias("n"), F.min("ta").alias("coldest"), F.max("ta").alias("warmest"),
        *(F.sum(F.col("nee") * x).alias(f"yg{i}") for i, x in enumerate(g)), *(F.sum(x * x).alias(f"gg{i}") for i, x in enumerate(g)),
    )
    return sums, at


def partition_night(df: DataFrame, e0: tuple[int, ...] = tuple(range(30, 455, 5)), days: int = 15, every: int = 5, least: int = 6, dark: float = 10.0) -> DataFrame:
    """site, start, e0, rref, n: the night respiration fit of each window of `days`, every `every` days.

    Profile least squares: for a given E0 the model nee = rref * g(ta; E0) is linear, so rref and the squared error come from sums, two for each
    E0 of the short constant grid. A row is dealt to blocks of E0 (BLOCK sums of a kind at once keep the code compiled); the best is the least. No solver, no Python.
    """
    sums, at = _window_sums(df, e0, days, every, dark)
    fit = lambda i, e: F.struct(F.round(F.col("yy") - F.col(f"yg{i}") * F.col(f"yg{i}") / F.col(f"gg{i}"), 6).alias("sse"), e.alias("e0"), (F.col(f"yg{i}") / F.col(f"gg{i}")).alias("rref"), F.col("n"))
    fits = [F.when(e.isNotNull(), fit(i, e)) for i, e in enumerate(at)]
    best = sums.where(F.col("n") >= least).select("site", "w", F.array_min(F.array(*fits)).alias("f")).groupBy("site", "w").agg(F.min("f").alias("f"))
    return best.select("site", F.expr(f"date_add(date'1970-01-01', w * {every})").alias("start"), "f.e0", "f.rref", "f.n")


def respiration(df: DataFrame, fits: DataFrame, every: int = 5, days: int = 15) -> DataFrame:
    """df with reco and gpp = reco - nee, by the fit whose window is centred nearest before each day (none before the first)."""
    day = F.datediff(F.col("t").cast("date"), F.lit("1970-01-01").cast("date"))
    middle = F.floor((day - days // 2) / every).cast("int")
    own = df.withColumn("start", F.date_add(F.lit("1970-01-01").cast("date"), middle * every))
    reco = F.col("rref") * temperature_response(F.col("ta"), F.col("e0").cast("double"))
    got = own.join(fits.select("site", "start", "e0", "rref"), ["site", "start"], "left").withColumn("reco", reco)
    return got.withColumn("gpp", F.col("reco") - F.col("nee")).drop("start", "e0", "rref")


def partition_day(df: DataFrame, days: int = 4, least: int = 12, steps: int = 60, dark: float = 10.0) -> DataFrame:
    """site, w, alpha, beta, gamma, n, converged: rectangular-hyperbola light responses nee = gamma - alpha beta rg / (alpha rg + beta) of the day rows.

    One bounded group (a site's few days) is fitted at a time, by damped Gauss-Newton from a fixed start with a fixed number of steps.
    """
    day = F.floor(F.datediff(F.col("t").cast("date"), F.lit("1970-01-01").cast("date")) / days).cast("int")
    own = df.where((F.col("swin") >= dark) & F.col("nee").isNotNull()).select("site", day.alias("w"), "nee", F.col("swin").alias("rg"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y, x = pdf["nee"].to_numpy(), pdf["rg"].to_numpy()
        p, damping, done = np.array([0.05, max(1.0, float(y.max() - y.min())), float(np.median(y))]), 1.0, False
        model = lambda q: q[2] - q[0] * q[1] * x / (q[0] * x + q[1])
        error = float(((y - model(p)) ** 2).sum())
        for _ in range(steps if len(y) >= least else 0):
            a, b, _ = p
            low = (a * x + b) ** 2
            j = np.stack([-b * b * x / low, -a * a * x * x / low, np.ones_like(x)], axis=1)
            move = np.linalg.solve(j.T @ j + damping * np.eye(3), j.T @ (y - model(p)))
            q = np.clip(p + move, [1e-4, 1e-2, -50], [1.0, 500, 50])
            e = float(((y - model(q)) ** 2).sum())
            if e < error:
                done = error - e < 1e-10 * max(1.0, error)
                p, error, damping = q, e, damping / 3
            else:
                damping *= 4
            if done:
                break
        return pd.DataFrame([(pdf["site"].iloc[0], int(pdf["w"].iloc[0]), *map(float, p), len(y), bool(done))], columns=["site", "w", "alpha", "beta", "gamma", "n", "converged"])

    return own.groupBy("site", "w").applyInPandas(fit, "site string, w int, alpha double, beta double, gamma double, n long, converged boolean")


def night_sensitivity(df: DataFrame, e0: tuple[int, ...] = tuple(range(30, 455, 5)), days: int = 15, every: int = 5, least: int = 6, span: float = 5.0, dark: float = 10.0) -> DataFrame:
    """site, w, e0, se, n: the temperature sensitivity of each window that determines one, with its standard error.

    The squared error over the grid of E0 (see partition_night) has its least point inside the grid; a parabola through it and its
    neighbours gives E0, and its curvature the standard error. Windows with under `least` rows, a range of temperatures under `span` degrees, the least error at an end of the
    grid or a standard error over half of E0 give none.
    """
    step = e0[1] - e0[0]
    sums, at = _window_sums(df, e0, days, every, dark)
    fits = [F.when(e.isNotNull(), F.struct(e.alias("e0"), (F.col("yy") - F.col(f"yg{i}") * F.col(f"yg{i}") / F.col(f"gg{i}")).alias("sse"))) for i, e in enumerate(at)]
    sums = sums.where((F.col("n") >= least) & (F.col("warmest") - F.col("coldest") >= span))
    own = sums.select("site", "w", "n", F.array_compact(F.array(*fits)).alias("f")).groupBy("site", "w").agg(F.max("n").alias("n"), F.array_sort(F.flatten(F.collect_list("f"))).alias("f"))
    own = own.withColumn("best", F.array_min(F.transform("f", lambda x: F.struct(F.round(x["sse"], 9).alias("sse"), x["e0"].alias("e0"))))["e0"])
    sse = lambda shift: F.get("f", ((F.col("best") - e0[0]) / step + shift).cast("int"))["sse"]
    own = own.select("site", "w", "n", "best", sse(-1).alias("before"), sse(0).alias("least"), sse(1).alias("after"))
    bend = F.col("after") + F.col("before") - 2 * F.col("least")
    own = own.where(F.col("before").isNotNull() & F.col("after").isNotNull() & (bend > 0) & (F.col("n") > 2))
    own = own.select("site", "w", (F.col("best") - step * (F.col("after") - F.col("before")) / (2 * bend)).alias("e0"), F.sqrt(2 * F.greatest(F.col("least"), F.lit(0.0)) / (F.col("n") - 2) / (bend / step**2)).alias("se"), "n")
    return own.where("se <= 0.5 * e0")


def site_sensitivity(fits: DataFrame, best: int = 3, days: int = 15, every: int = 5) -> DataFrame:
    """site, year, e0: the mean of the `best` windows of least standard error in each site's year, by the window's middle; no row where there is none."""
    year = F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.col("w") * every + days // 2))
    ranked = fits.withColumn("year", year).withColumn("_r", F.row_number().over(Window.partitionBy("site", "year").orderBy("se", "w")))
    return ranked.where(F.col("_r") <= best).groupBy("site", "year").agg(F.avg("e0").alias("e0"))


def night_reference(df: DataFrame, sensitivity: DataFrame, days: int = 7, every: int = 4, least: int = 6, dark: float = 10.0) -> DataFrame:
    """site, at (seconds since 1970, the mean of the rows'), rref, e0, n: reference respiration of each window, with the site's year's E0 fixed. Windows without a positive one give none."""
    night = df.where((F.col("swin") < dark) & F.col("nee").isNotNull() & (F.col("ta") > T_ZERO + 1)).select("site", "t", "nee", "ta", F.explode(windows_of(days, every)).alias("w"))
    night = night.withColumn("year", F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.col("w") * every + days // 2))).join(sensitivity, ["site", "year"])
    g = temperature_response(F.col("ta"), F.col("e0"))
    own = night.groupBy("site", "w", "e0").agg((F.sum(F.col("nee") * g) / F.sum(g * g)).alias("rref"), F.avg(seconds()).alias("at"), F.count("*").alias("n"))
    return own.where((F.col("n") >= least) & (F.col("rref") > 0)).select("site", "at", "rref", "e0", "n")


def seconds() -> Column:
    return F.unix_seconds(F.col("t").cast("timestamp")).cast("double")


def between_marks(df: DataFrame, marks: DataFrame, names: list[str]) -> DataFrame:
    """df with `before` and `after`, the structs (at, names) of the site's nearest marks (site, at, names) at or before t and after it, null where there is none."""
    mark = F.struct("at", *names)
    rows = df.withColumns({"_at": seconds(), "_m": F.lit(None).cast(marks.select(mark.alias("m")).schema["m"].dataType)})
    both = rows.unionByName(marks.select("site", F.col("at").alias("_at"), mark.alias("_m")), allowMissingColumns=True)
    past = Window.partitionBy("site").orderBy("_at", F.col("_m").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("site").orderBy(F.desc("_at"), F.col("_m").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    got = both.withColumns({"before": F.last("_m", True).over(past), "after": F.last("_m", True).over(ahead)})
    return got.where("t is not null").drop("_m")


def linear(at: Column, before: Column, after: Column, value) -> Column:
    """value(before) and value(after) weighted by nearness in time; at the ends the one there is."""
    a, b = value(before), value(after)
    share = (at - before["at"]) / (after["at"] - before["at"])
    return F.coalesce(a + (b - a) * share, a, b)


def night_fluxes(df: DataFrame, marks: DataFrame) -> DataFrame:
    """df with reco and gpp = reco - nee; reference respiration is linear in time between the windows' middles."""
    own = between_marks(df, marks, ["rref", "e0"])
    rref = linear(F.col("_at"), F.col("before"), F.col("after"), lambda m: m["rref"])
    e0 = F.coalesce(F.col("before")["e0"], F.col("after")["e0"])
    got = own.withColumn("reco", rref * temperature_response(F.col("ta"), e0))
    return got.withColumn("gpp", F.col("reco") - F.col("nee")).drop("_at", "before", "after")


#: Bounds beyond which a light response is refused: initial slope, uptake at saturation.
MOST_ALPHA, MOST_BETA = 0.22, 250.0


def _light_model(p: np.ndarray, rg: np.ndarray, r: np.ndarray, dry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Net exchange and its derivatives by alpha, beta, k and rref."""
    alpha, beta, k, rref = p
    fall = np.exp(-k * dry)
    top = beta * fall
    low = alpha * rg + top
    by_top = -((alpha * rg) ** 2) / low**2
    return rref * r - alpha * top * rg / low, np.stack([-rg * top * top / low**2, by_top * fall, -by_top * dry * top, r], axis=1)


def _light_fit(y: np.ndarray, rg: np.ndarray, r: np.ndarray, dry: np.ndarray, start: np.ndarray, free: list[int], steps: int = 100) -> np.ndarray | None:
    """Damped Gauss-Newton over the free parameters, from a fixed start, with a fixed number of steps at most; None if it doesn't settle."""
    p, damping = start.copy(), 1e-2
    f, j = _light_model(p, rg, r, dry)
    error = float(((y - f) ** 2).sum())
    for _ in range(steps):
        own = j[:, free]
        a = own.T @ own
        q = p.copy()
        q[free] += np.linalg.lstsq(a + damping * np.diag(np.diag(a) + 1e-12), own.T @ (y - f), rcond=None)[0]
        with np.errstate(all="ignore"):
            f2, j2 = _light_model(q, rg, r, dry)
            e2 = float(((y - f2) ** 2).sum())
        if np.isfinite(e2) and np.isfinite(j2).all() and e2 <= error:
            settled = error - e2 <= 1e-12 * max(1.0, error)
            p, f, j, error, damping = q, f2, j2, e2, damping / 5
            if settled:
                return p
        else:
            damping *= 5
            if damping > 1e12:
                return p
    return None


def light_responses(df: DataFrame, sensitivity: DataFrame, days: int = 4, every: int = 2, least: int = 20, dry_above: float = 10.0, dark: float = 10.0, night_days: int = 12) -> DataFrame:
    """site, w, at, alpha, beta, k, rref, e0, n, how: light responses of the day rows of each window; `how` is null where none is accepted.

    nee = rref g(ta; E0) - alpha B swin / (alpha swin + B), where B = beta exp(-k (vpd - dry_above)) above that deficit (hPa), else beta. E0 comes from the night rows:
    sensitivity (site, w, e0, of windows of night_days at the same steps), bounded to 50 to 400, the last one before or else the next where a window has none.
    The cascade: all parameters (`all`); with k = 0 if k is negative or can't be told (`k0`); with the last accepted window's alpha if alpha leaves its bounds
    (`alpha`, `alpha_k0`). Windows whose beta or rref still leave theirs are refused. One bounded group, a site's few days, is fitted at a time.
    """
    shift = (night_days - days) // 2 // every
    day = df.where((F.col("swin") >= dark) & F.col("nee").isNotNull() & F.col("ta").isNotNull() & F.col("vpd").isNotNull()).select("site", seconds().alias("at"), "nee", F.col("swin").alias("rg"), "ta", "vpd", F.explode(windows_of(days, every)).alias("w"))
    known = sensitivity.select("site", (F.col("w") + shift).alias("w"), F.least(F.greatest("e0", F.lit(50.0)), F.lit(400.0)).alias("e0"))
    own = day.select("site", "w").distinct().join(known, ["site", "w"], "full_outer")
    last = F.last("e0", True).over(Window.partitionBy("site").orderBy("w").rowsBetween(Window.unboundedPreceding, 0))
    then = F.last("e0", True).over(Window.partitionBy("site").orderBy(F.desc("w")).rowsBetween(Window.unboundedPreceding, 0))
    rows = day.join(own.select("site", "w", F.coalesce(last, then).alias("e0")).where("e0 is not null"), ["site", "w"]).withColumn("fixed", F.lit(None).cast("double"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y, rg, ta, vpd, e0 = (pdf[c].to_numpy(float) for c in ("nee", "rg", "ta", "vpd", "e0"))
        fixed, n = pdf["fixed"].iloc[0], len(pdf)
        r = np.exp(e0 * (1 / (T_REF - T_ZERO) - 1 / (ta - T_ZERO)))
        dry = np.maximum(vpd - dry_above, 0)
        dim = y[rg <= np.quantile(rg, 0.2)].mean() / r.mean()
        start = np.array([0.05 if pd.isna(fixed) else fixed, max(1.0, float(np.quantile(y, 0.97) - np.quantile(y, 0.03))), 0.0, max(0.5, dim)])
        chosen, how = None, None
        if n >= least:
            head = [] if pd.notna(fixed) else [0]
            tries = [(head + [1, 2, 3], "all")] if (dry > 0).sum() >= 5 else []
            for free, name in [*tries, (head + [1, 3], "k0")]:
                p = _light_fit(y, rg, r, dry, start, free)
                if p is None or p[2] < 0:
                    continue
                if not 0 < p[0] <= MOST_ALPHA:
                    how = "slope"
                elif 0 < p[1] <= MOST_BETA and p[3] > 0:
                    chosen, how = p, name if pd.isna(fixed) else "alpha" if name == "all" else "alpha_k0"
                    break
        p = chosen if chosen is not None else np.full(4, np.nan)
        return pd.DataFrame([(pdf["site"].iloc[0], int(pdf["w"].iloc[0]), float(pdf["at"].mean()), *map(float, p), float(e0[0]), n, how)], columns=["site", "w", "at", "alpha", "beta", "k", "rref", "e0", "n", "how"])

    kinds = "site string, w int, at double, alpha double, beta double, k double, rref double, e0 double, n long, how string"
    first = cut(rows.groupBy("site", "w").applyInPandas(fit, kinds))
    before = F.last(F.when(~F.isnan("alpha"), F.col("alpha")), True).over(Window.partitionBy("site").orderBy("w").rowsBetween(Window.unboundedPreceding, 0))
    again = first.withColumn("fixed", before).where("how = 'slope' and fixed is not null").select("site", "w", "fixed")
    second = rows.drop("fixed").join(again, ["site", "w"]).groupBy("site", "w").applyInPandas(fit, kinds)
    got = first.join(again, ["site", "w"], "left_anti").unionByName(second)
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c in ("alpha", "beta", "k", "rref")}
    return got.withColumns(clean | {"how": F.when(~F.isnan("alpha"), F.col("how"))})


def day_fluxes(df: DataFrame, responses: DataFrame, dry_above: float = 10.0) -> DataFrame:
    """df with reco_dt and gpp_dt of every row: what the accepted windows before and after it predict, weighted by nearness in time."""
    names = ["alpha", "beta", "k", "rref", "e0"]
    own = between_marks(df, responses.where("how is not null").select("site", "at", *names), names)
    dry = F.greatest(F.col("vpd") - dry_above, F.lit(0.0))

    def uptake(m: Column) -> Column:
        top = m["beta"] * F.exp(-m["k"] * dry)
        return m["alpha"] * top * F.col("swin") / (m["alpha"] * F.col("swin") + top)

    at, before, after = F.col("_at"), F.col("before"), F.col("after")
    got = own.withColumns({"reco_dt": linear(at, before, after, lambda m: m["rref"] * temperature_response(F.col("ta"), m["e0"])), "gpp_dt": linear(at, before, after, uptake)})
    return got.drop("_at", "before", "after")
