"""Daily series: zero-filled volumes, trends, naive and seasonal forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.time import ape, edge

# Held-out and forecast days, and the edge over the naive forecast from which a model wins.
HORIZON, MIN_EDGE = 28, 0.10
# The region's holidays; Ramadan as first and last day of each year's, the others by day.
RAMADAN = [("2024-03-11", "2024-04-09"), ("2025-03-01", "2025-03-30"), ("2026-02-18", "2026-03-19")]
HOLIDAYS = {
    "eid_fitr": ["2024-04-10", "2025-03-31", "2026-03-20"],
    "eid_adha": ["2024-06-16", "2025-06-06", "2026-05-27"],
    "national_day": ["2023-09-23", "2024-09-23", "2025-09-23", "2026-09-23"],
    "founding_day": ["2024-02-22", "2025-02-22", "2026-02-22"],
}


def daily_volume(df: DataFrame, time: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, ds, y): rows a day, 0 on days without any between a group's first and last day."""
    days = df.where(F.col(time).isNotNull()).groupBy(*groups, F.col(time).cast("date").alias("ds")).agg(F.count("*").alias("y"))
    ends = days.groupBy(*groups).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    spine = ends.where("lo is not null").select(*groups, F.explode(F.sequence("lo", "hi")).alias("ds"))
    counted = days.select(*[F.col(c).alias(f"__{c}") for c in (*groups, "ds")], F.col("y"))
    joined = spine.join(counted, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*groups, "ds")]), "left")
    return joined.select(*groups, "ds", F.coalesce("y", F.lit(0)).alias("y"))


def volume(df: DataFrame, time: str, freq: str = "D") -> DataFrame:
    """(bucket, n) by day, week, month or hour, zero-filled."""
    unit, step = {"D": ("DAY", "1 day"), "W": ("WEEK", "7 days"), "M": ("MONTH", "1 month"), "H": ("HOUR", "1 hour")}[freq]
    at = F.date_trunc(unit, F.col(time)).cast("timestamp_ntz")
    counts = df.where(F.col(time).isNotNull()).groupBy(at.alias("bucket")).agg(F.count("*").alias("n"))
    spine = counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).where("lo is not null").select(F.explode(F.expr(f"sequence(lo, hi, interval {step})")).alias("bucket"))
    return spine.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def weekday_means(daily: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, weekday, days, total): mean volume a weekday is total / days."""
    return daily.groupBy(*groups, F.weekday("ds").alias("weekday")).agg(F.count("*").alias("days"), F.sum("y").alias("total"))


def monthly_trend(df: DataFrame, time: str, groups: Sequence[str], zero_fill: bool = False) -> DataFrame:
    """(groups, months, trend): the last three months' mean against that of the months before.

    Only months with rows count, unless zero_fill; under three of them there is not enough history,
    and exactly three have nothing to be compared with, which is stable.
    """
    counts = df.where(F.col(time).isNotNull()).groupBy(*groups, F.trunc(time, "MM").alias("month")).agg(F.count("*").alias("n"))
    if zero_fill:
        spine = counts.groupBy(*groups).agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(*groups, F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month"))
        counts = spine.join(counts, [*groups, "month"], "left").na.fill(0, ["n"])
    last = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("month")))
    row = counts.withColumn("back", last).groupBy(*groups).agg(F.count("*").alias("months"), F.avg(F.when(F.col("back") <= 3, F.col("n"))).alias("recent"), F.avg(F.when(F.col("back") > 3, F.col("n"))).alias("earlier"))
    trend = (
        F.when(F.col("months") < 3, "insufficient history")
        .when(F.col("recent") > F.col("earlier") * 1.25, "rising")
        .when(F.col("recent") < F.col("earlier") * 0.75, "falling")
        .otherwise("stable")
    )
    return row.select(*groups, "months", trend.alias("trend"))


def holdout(daily: DataFrame, groups: Sequence[str] = (), days: int = HORIZON) -> DataFrame:
    """``daily`` with ``back``: 1 for a group's last day; those up to ``days`` are held out."""
    return daily.withColumn("back", F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("ds"))))


def naive_forecast(train: DataFrame, horizon: int, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, step, yhat): the value seven days before, again and again.

    Under seven values the last one fills a week up, which then repeats; no values give 0.
    """
    back = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("ds")))
    week = train.withColumn("back", back).where(F.col("back") <= 7).groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("w"))
    have = F.size("w")
    step = F.col("step")
    # where seven values are missing, the first steps repeat the last value until there are seven
    fill = F.greatest(7 - have, F.lit(0))
    at = F.when(step <= fill, have - 1).otherwise((step - 1 - fill) % 7)
    value = F.when(at < have, F.get("w", at)["y"]).otherwise(F.get("w", have - 1)["y"])
    steps = week.select(*groups, "w", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(*groups, "step", F.coalesce(value, F.lit(0)).cast("double").alias("yhat"))


def evaluate_naive(daily: DataFrame, groups: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """(groups, days, mape): how the naive forecast does on the held-out days."""
    marked = holdout(daily, groups, horizon)
    test = marked.where(F.col("back") <= horizon).withColumn("step", horizon + 1 - F.col("back"))
    forecast = naive_forecast(marked.where(F.col("back") > horizon), horizon, groups)
    return test.join(forecast, [*groups, "step"]).groupBy(*groups).agg(F.count("*").alias("days"), F.avg(ape(F.col("y"), F.col("yhat"))).alias("mape"))


def verdict(df: DataFrame, naive: str = "naive_mape", model: str = "model_mape") -> DataFrame:
    """Adds ``edge`` and ``winner``."""
    e = edge(F.col(naive), F.col(model))
    return df.withColumn("edge", e).withColumn("winner", F.when(e >= MIN_EDGE, "model").otherwise("naive"))


def overall(verdicts: DataFrame) -> DataFrame:
    """One row: the model is recommended if it wins over half of the series."""
    return verdicts.agg(F.count("*").alias("n"), F.count_if(F.col("winner") == "model").alias("wins")).select("n", "wins", (F.col("wins") * 2 > F.col("n")).alias("recommended"))


def holidays(spark: SparkSession) -> DataFrame:
    """(holiday, ds, day): each holiday and the day after it (day 1)."""
    spans = [("ramadan", a, b) for a, b in RAMADAN] + [(n, d, d) for n, days in HOLIDAYS.items() for d in days]
    rows = spark.createDataFrame(spans, "holiday string, a string, b string")
    each = rows.select("holiday", F.explode(F.sequence(F.col("a").cast("date"), F.col("b").cast("date"))).alias("on"))
    return each.select("holiday", F.explode(F.array(F.lit(0), F.lit(1))).alias("day"), "on").select("holiday", F.date_add("on", F.col("day")).alias("ds"), "day")


def on_holidays(daily: DataFrame) -> DataFrame:
    """(holiday, ds, day, y): the calendar with a daily series' values, 0 on days that it doesn't have."""
    days = holidays(daily.sparkSession)
    # the calendar is fixed: some hundred days, so the series is cut down to them where it is
    held = daily.join(F.broadcast(days.select("ds").distinct()), "ds").select("ds", "y")
    return days.join(held, "ds", "left").select("holiday", "ds", "day", F.coalesce("y", F.lit(0)).alias("y"))


#: Places where the trend may bend, the share of a series in which they lie, and the weights of the penalties.
BENDS, BENDING, SPARSE, RIDGE = 20, 0.85, 0.02, 0.1
#: Courses that are simulated for the band.
COURSES = 400


def _season(ds: pd.Series, t: np.ndarray, days: float, special: set) -> np.ndarray:
    """Weekdays, two yearly harmonics and holidays."""
    parts = [(pd.to_datetime(ds).dt.weekday == d).to_numpy(float) for d in range(6)]
    if days >= 365:
        parts += [f(2 * np.pi * k * t / 365.25) for k in (1, 2) for f in (np.sin, np.cos)]
    parts.append(pd.to_datetime(ds).dt.date.isin(special).to_numpy(float))
    return np.stack(parts, 1)


def fit_bends(x: np.ndarray, hinges: np.ndarray, y: np.ndarray, sparse: float = SPARSE, ridge: float = RIDGE, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """(beta, bends) of y = x @ beta + hinges @ bends: ridge for beta, an absolute penalty for bends, so that few differ from 0.

    Coordinate descent over the bends, whose columns are cleared of what x explains; ``sparse`` is a share of the penalty at which all would be 0.
    """
    solve = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T)
    own, rest = hinges - x @ (solve @ hinges), y - x @ (solve @ y)
    bends, size, left = np.zeros(hinges.shape[1]), (own**2).sum(0), rest.copy()
    most = np.abs(own.T @ rest).max(initial=0.0)
    for _ in range(rounds if most > 0 else 0):
        moved = 0.0
        for j in np.flatnonzero(size > 1e-12):
            pull = own[:, j] @ left + size[j] * bends[j]
            new = np.sign(pull) * max(abs(pull) - sparse * most, 0.0) / size[j]
            if new != bends[j]:
                left -= own[:, j] * (new - bends[j])
                moved, bends[j] = max(moved, abs(new - bends[j])), new
        if moved < 1e-9:
            break
    return solve @ (y - hinges @ bends), bends


def seasonal_forecast(daily: DataFrame, group: str, horizon: int = HORIZON, multiplicative: bool = False, level: float = 0.8) -> DataFrame:
    """(group, ds, yhat, yhat_lower, yhat_upper) for the days after each group's last one.

    A trend that may bend, weekdays, yearly harmonics and holidays, in logarithms if multiplicative. The band is that of simulated
    courses, in which the trend bends on as often and as much as it has, with residuals drawn again. A group is one daily series.
    """
    special = {r.ds for r in holidays(daily.sparkSession).collect()}  # a fixed calendar of some hundred days
    schema = "`group` string, ds date, yhat double, yhat_lower double, yhat_upper double"

    def fit(key, pdf):
        pdf = pdf.sort_values("ds")
        first, n = pd.Timestamp(pdf.ds.iloc[0]), len(pdf)
        t = (pd.to_datetime(pdf.ds) - first).dt.days.to_numpy(float)
        span = max(1.0, t[-1])
        y = pdf.y.to_numpy(float)
        y = np.log1p(y) if multiplicative else y
        at = np.linspace(0, BENDING * span, min(BENDS, max(0, n // 7 - 1)) + 1)[1:]
        hinge = lambda t: np.maximum(t[:, None] - at, 0) / span
        design = lambda ds, t: np.concatenate([np.ones((len(t), 1)), t[:, None] / span, _season(ds, t, span + 1, special)], 1)
        x = design(pdf.ds, t)
        beta, bends = fit_bends(x, hinge(t), y)
        residual = y - x @ beta - hinge(t) @ bends
        ahead = pd.Series(pd.date_range(pd.Timestamp(pdf.ds.iloc[-1]) + pd.Timedelta(days=1), periods=horizon))
        later = t[-1] + 1 + np.arange(horizon, dtype=float)
        out = design(ahead, later) @ beta + hinge(later) @ bends
        r = np.random.default_rng(n)
        # bends to come: as many a day as there were places for one, as large as those were on average
        chance, size = len(at) / span, np.abs(bends).mean() if len(bends) else 0.0
        bend = (r.random((COURSES, horizon)) < chance) * r.laplace(0, max(size, 1e-12), (COURSES, horizon)) / span
        course = out + np.cumsum(np.cumsum(bend, 1), 1) + r.choice(residual, (COURSES, horizon))
        low, high = np.quantile(course, [(1 - level) / 2, (1 + level) / 2], axis=0)
        cols = [np.clip(np.expm1(v) if multiplicative else v, 0, None) for v in (out, low, high)]
        return pd.DataFrame({"group": key[0], "ds": ahead.dt.date, "yhat": cols[0], "yhat_lower": cols[1], "yhat_upper": cols[2]})

    rows = daily.select(F.col(group).cast("string").alias("group"), "ds", F.col("y").cast("double").alias("y"))
    return rows.groupBy("group").applyInPandas(fit, schema)


def daily_with_all(df: DataFrame, time: str, group: str, top: int = 3) -> DataFrame:
    """(group, ds, y): the daily series ``ALL`` of all rows and those of the groups with the most rows, zero-filled, from one pass by
    grouping sets; ties go to the lesser name."""
    rows = df.where(F.col(time).isNotNull()).select(F.col(group).cast("string").alias("g"), F.col(time).cast("date").alias("ds"))
    most = rows.where("g is not null").groupBy("g").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "g").limit(top).select(F.col("g").alias("named"))
    known = rows.join(F.broadcast(most), F.col("g") == F.col("named"), "left").select("named", "ds")  # ``top`` rows
    counts = known.groupingSets([["named", "ds"], ["ds"]], "named", "ds").agg(F.count("*").alias("y"), F.grouping("named").alias("whole"))
    days = counts.where("whole = 1 or named is not null").select(F.when(F.col("whole") == 1, "ALL").otherwise(F.col("named")).alias("group"), "ds", "y")
    spine = days.groupBy("group").agg(F.explode(F.sequence(F.min("ds"), F.max("ds"))).alias("ds"))
    return spine.join(days, ["group", "ds"], "left").select("group", "ds", F.coalesce("y", F.lit(0)).alias("y"))


def forecast_teams(df: DataFrame, time: str, group: str, horizon: int = HORIZON, top: int = 3, multiplicative: bool = False) -> DataFrame:
    """Forecasts of all rows together (``ALL``) and of the groups with the most rows, as ``seasonal_forecast`` gives them."""
    return seasonal_forecast(daily_with_all(df, time, group, top), "group", horizon, multiplicative)


def evaluate_seasonal(daily: DataFrame, group: str, horizon: int = HORIZON) -> DataFrame:
    """(group, naive_mape, model_mape, edge, winner) on each series' held-out days."""
    rows = daily.select(F.col(group).cast("string").alias("group"), "ds", "y")
    marked = holdout(rows, ["group"], horizon)
    train, test = marked.where(F.col("back") > horizon), marked.where(F.col("back") <= horizon)
    model = seasonal_forecast(train, "group", horizon).join(test, ["group", "ds"]).groupBy("group").agg(F.avg(ape(F.col("y"), F.col("yhat"))).alias("model_mape"))
    naive = evaluate_naive(rows, ["group"], horizon).select("group", F.col("mape").alias("naive_mape"))
    return verdict(naive.join(model, "group"))
