"""Filters, indicators, counts and label reports over a table of tickets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import in_range, round_half_up

# The states that count as closed, and the share of nulls from which a label is weak.
CLOSED = ("Closed", "Resolved")
WEAK_FROM = 40.0
ABSENT = "—"


def filter_rows(df: DataFrame, equal: dict[str, Sequence] = {}, time: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows whose columns have one of the given values (none given: any), from start to the midnight after end."""
    for c, values in equal.items():
        if values and c in df.columns:
            df = df.where(F.col(c).isin(*values))
    if time is not None and (start is not None or end is not None):
        df = df.where(in_range(F.col(time), start, end))
    return df


def kpis(df: DataFrame, status: str, overdue: Column, group: str, hours: Column | None = None, closed: Sequence[str] = CLOSED) -> DataFrame:
    """One row: total, open, closed_pct, overdue_pct, n_groups, mean_hours. A null status is open."""
    total = F.count("*")
    shut = F.count_if(F.coalesce(F.col(status).isin(*closed), F.lit(False)))
    share = lambda n: F.when(total > 0, n * F.lit(100.0) / total).otherwise(F.lit(0.0))
    mean = F.avg(hours) if hours is not None else F.lit(None).cast("double")
    return df.agg(
        total.alias("total"),
        (total - shut).alias("open"),
        share(shut).alias("closed_pct"),
        share(F.count_if(F.coalesce(overdue, F.lit(False)))).alias("overdue_pct"),
        F.count_distinct(group).alias("n_groups"),
        mean.alias("mean_hours"),
    )


def value_counts(df: DataFrame, column: str, top: int = 12, null: str = ABSENT) -> DataFrame:
    """(value, n) of the most frequent values; equal counts go by value."""
    counts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(null)).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(top)


def value_counts_all(df: DataFrame, columns: Sequence[str], top: int = 12, null: str = ABSENT) -> DataFrame:
    """(field, value, n): ``value_counts`` of several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit(null)).alias("value")) for c in columns if c in df.columns])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n"))
    best = Window.partitionBy("field").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).drop("rank")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, null_pct, weak) for the columns there are, in one pass."""
    there = [c for c in columns if c in df.columns]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in there], F.count("*").alias("_rows"))
    pct = lambda c: F.when(F.col("_rows") > 0, round_half_up(F.col(c) * 100.0 / F.col("_rows"), 1))
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), pct(c).alias("null_pct")) for c in there])
    return row.select(F.explode(pairs).alias("p")).select("p.field", "p.null_pct", (F.col("p.null_pct") >= WEAK_FROM).alias("weak"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, n) of equal widths from the least to the largest value, which is in the last bin; empty bins have 0."""
    x = F.col(column).try_cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    values = df.where(x.isNotNull()).select(x.alias("x"), ends.alias("e"))
    at = F.least(F.floor((F.col("x") - F.col("e.lo")) / F.nullif(F.col("e.hi") - F.col("e.lo"), F.lit(0.0)) * bins), F.lit(bins - 1))
    counts = values.groupBy(F.coalesce(at, F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def split_predicted(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(rows that the system gave, one row with ``excluded``: how many were predicted). Without the column, all rows."""
    if source not in df.columns:
        return df, df.agg(F.lit(0).cast("bigint").alias("excluded"))
    predicted = F.col(source).eqNullSafe("predicted")
    return df.where(~predicted), df.agg(F.count_if(predicted).alias("excluded"))


def recommend(df: DataFrame, group: str, overdue: Column) -> DataFrame:
    """One row: whether the group column and the overdue flag are fit to be learnt."""
    total = F.count("*")
    null_pct = F.when(total > 0, F.count_if(F.col(group).isNull()) * 100.0 / total).otherwise(0.0)
    rate = F.when(total > 0, F.count_if(F.coalesce(overdue, F.lit(False))) / total).otherwise(0.0)
    row = df.agg(null_pct.alias("group_null_pct"), F.count_distinct(group).alias("n_groups"), rate.alias("overdue_rate"))
    return row.select("*", ((F.col("group_null_pct") < WEAK_FROM) & (F.col("n_groups") >= 2)).alias("routing_viable"), ((F.col("overdue_rate") > 0.05) & (F.col("overdue_rate") < 0.95)).alias("overdue_viable"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, nulls first.

    An aggregate, so each task sends one row a key on, however often a key is repeated.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return best.select(*[F.col(c) if c in keys else F.col("__first")[c].alias(c) for c in df.columns])


def cluster_summary(df: DataFrame, cluster: str, modes: Sequence[str], top: int = 10) -> DataFrame:
    """Size and most frequent values of the largest clusters, noise (-1) left out; equal counts go by value."""
    kept = df.where(F.col(cluster) != -1)
    row = kept.groupBy(cluster).agg(F.count("*").alias("n"), *[F.mode(c, True).alias(f"top_{c}") for c in modes])
    return row.orderBy(F.desc("n"), cluster).limit(top)


def noise_share(df: DataFrame, cluster: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.count_if(F.col(cluster) == -1).alias("n_noise"), F.count_distinct(F.when(F.col(cluster) != -1, F.col(cluster))).alias("n_clusters"))


def cluster_labels(df: DataFrame, cluster: str, words: Column, top: int = 4) -> DataFrame:
    """(cluster, label): each cluster's most frequent words joined by `` / ``, or "unlabelled"."""
    counts = df.select(cluster, F.explode(words).alias("word")).groupBy(cluster, "word").agg(F.count("*").alias("n"))
    best = Window.partitionBy(cluster).orderBy(F.desc("n"), "word")
    kept = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    label = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), " / ")
    return df.select(cluster).distinct().join(kept.groupBy(cluster).agg(label.alias("label")), cluster, "left").select(cluster, F.coalesce("label", F.lit("unlabelled")).alias("label"))


def problem_metrics(df: DataFrame, status: str = "status", usable: str = "has_resolution", closed: Sequence[str] = CLOSED) -> DataFrame:
    """One row: total, resolved, usable_pct (rows with a resolution that says something; null is none). Absent columns give 0."""
    total = F.count("*")
    done = F.count_if(F.coalesce(F.col(status).isin(*closed), F.lit(False))) if status in df.columns else F.lit(0).cast("bigint")
    good = F.count_if(F.coalesce(F.col(usable), F.lit(False))) if usable in df.columns else F.lit(0)
    return df.agg(total.alias("total"), done.alias("resolved"), F.when(total > 0, good * F.lit(100.0) / total).otherwise(F.lit(0.0)).alias("usable_pct"))


def time_range(df: DataFrame, time: str) -> DataFrame:
    """One row (first, last): the days of the earliest and latest time; null without any."""
    return df.agg(F.min(time).cast("date").alias("first"), F.max(time).cast("date").alias("last"))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under the names that are shown; those that are not there are left out of account."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def shown(value: Column, form: str) -> Column:
    """A number as it is shown: ``count`` (1,234), ``percent`` (12%), ``hours`` (1.5 h); null is a dash."""
    made = {"count": F.format_number(value, 0), "percent": F.concat(F.format_number(value, 0), F.lit("%")), "hours": F.concat(F.format_number(value, 1), F.lit(" h"))}[form]
    return F.coalesce(made, F.lit(ABSENT))
