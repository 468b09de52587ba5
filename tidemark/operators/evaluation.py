"""Splits that respect time, label folding, leakage checks and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import BROADCAST_ROWS, checkpoint, small

# What is known when a ticket is made, and what only comes later.
AT_CREATION = (
    "subject description short_description template site is_service_request requester_dept requester_site "
    "created_hour created_dayofweek created_month subject_len desc_len lang"
).split()
LATER = (
    "technician_name technician_email technician_id technician_dept technician_site status priority due_by_time closed_time "
    "resolution_hours resolution notes_count attachments_count is_overdue cancel_requested created_by_name created_by_email "
    "created_by_id created_by_dept created_by_site"
).split()


def assert_no_leakage(columns: Sequence[str], allowed_only: bool = False) -> None:
    """ValueError naming the columns that are not known at creation; with allowed_only, all that are not listed as known."""
    bad = [c for c in columns if c in LATER or (allowed_only and c not in AT_CREATION)]
    if bad:
        raise ValueError(f"not known when a ticket is made: {', '.join(bad)}")


def _ranked(df: DataFrame, by: list[Column], order: list[Column], parts: int | None) -> DataFrame:
    """(g, o, m, p): the group and order values of each row, sorted by them over range partitions.

    Only these columns are shuffled, once; the checkpoint keeps every row's place m, whose high bits
    are its partition p, so that all that follows counts the same order.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.struct(*by).alias("g"), F.struct(*order).alias("o"))
    dealt = rows.repartitionByRange(parts, "g", "o").sortWithinPartitions("g", "o").withColumn("m", F.monotonically_increasing_id())
    return checkpoint(dealt.withColumn("p", F.shiftright("m", 33)))


def _last_of(df: DataFrame, by: list[Column], order: list[Column], share: Column, parts: int | None) -> DataFrame:
    """(g, last): the order values of the floor(n * share)-th row of each group; null where that is none."""
    rows = _ranked(df, by, order, parts)
    # a group's rows in a partition follow each other: a row for each group and partition that it reaches
    runs = rows.groupBy("g", "p").agg(F.count("*").alias("n"), F.min("m").alias("m0"))
    of = Window.partitionBy("g")
    runs = runs.withColumn("before", F.sum("n").over(of.orderBy("p")) - F.col("n")).withColumn("k", F.floor(F.sum("n").over(of) * share + 1e-9))
    at = F.when((F.col("k") > F.col("before")) & (F.col("k") <= F.col("before") + F.col("n")), F.col("m0") + F.col("k") - F.col("before") - 1)
    wanted = runs.groupBy("g").agg(F.max(at).alias("m"))
    found = wanted.select("m").where("m is not null").join(rows.select("m", "o"), "m")
    return wanted.join(found, "m", "left").select("g", F.col("o").alias("last"))


def temporal_split(df: DataFrame, time: str, key: str, test_share: float = 0.2, parts: int | None = None) -> DataFrame:
    """``df`` with ``is_test``: False for the first int(n * (1 - share)) rows by time, nulls last, then key, nulls last.

    Rows with the same time and key go by a hash of their other columns; rows that are repeated in full
    stay on one side. The rows themselves are not moved: each is compared with the last one before the cut.
    """
    others = [F.col(c) for c, kind in df.dtypes if c not in (time, key) and not any(x in kind for x in ("map<", "variant"))]
    nulls_last = lambda c, name: [F.col(c).isNull().alias(f"no_{name}"), F.col(c).alias(name)]
    order = [*nulls_last(time, "t"), *nulls_last(key, "k"), (F.xxhash64(*others) if others else F.lit(0).cast("long")).alias("h")]
    last = checkpoint(_last_of(df, [F.lit(0).alias("all")], order, F.lit(1 - test_share), parts)).select("last").scalar()
    return df.withColumn("is_test", F.coalesce(F.struct(*order) > last, F.lit(True)))


def fold_top(df: DataFrame, label: str, k: int = 3, other: str = "Other", by: DataFrame | None = None) -> DataFrame:
    """``label`` with all but the k most frequent values (of ``by``, else df) as ``other``; equal counts go by value."""
    counts = (by if by is not None else df).where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("__n"))
    top = counts.orderBy(F.desc("__n"), label).limit(k).select(F.col(label).alias("__top"))
    joined = df.join(F.broadcast(top), F.col(label) == F.col("__top"), "left")  # k rows
    return joined.withColumn(label, F.coalesce("__top", F.lit(other))).drop("__top")


def fold_rare(df: DataFrame, label: str, least: int = 10, other: str = "__other__") -> DataFrame:
    """``label`` with values of fewer than ``least`` rows as ``other``; nulls stay.

    Counts are made before any shuffle. If few labels are kept, these are broadcast and no row of
    ``df`` moves; else those that may fill a task are broadcast, and only rows of other labels move.
    """
    counts = checkpoint(df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("__kept")).agg(F.count("*").alias("__n")).where(F.col("__n") >= least))
    fold = lambda rows: rows.withColumn(label, F.when(F.col(label).isNull() | F.col("__kept").isNotNull(), F.col(label)).otherwise(other)).drop("__kept")
    kept = counts.drop("__n")
    if counts.count() <= BROADCAST_ROWS:
        return fold(df.join(F.broadcast(kept), F.col(label) == F.col("__kept"), "left"))
    most = F.broadcast(counts.orderBy(F.desc("__n"), "__kept").limit(BROADCAST_ROWS // 4).select(F.col("__kept").alias("__hot")))
    marked = df.join(most, F.col(label) == F.col("__hot"), "left")
    hot = marked.where("__hot is not null").withColumn("__kept", F.col("__hot"))
    rest = marked.where("__hot is null").join(kept, F.col(label) == F.col("__kept"), "left")
    return fold(hot.unionByName(rest).drop("__hot"))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: str = "0") -> DataFrame:
    """``df`` with ``is_test``: of each class the first floor(n * share) rows in the order of a hash of the key.

    Rows with equal keys of one class stay on one side. Null is a class. One row a class, the last one
    that is taken, is joined to the rows, which don't move unless there are very many classes.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    place = [order.alias("h"), F.col(key).alias("k")]
    last = checkpoint(_last_of(df, [F.col(label).alias("g")], place, F.lit(test_share), None).select(F.col("g.g").alias("__g"), F.col("last").alias("__last")))
    joined = df.join(small(last), F.col(label).eqNullSafe(F.col("__g")), "left")
    return joined.withColumn("is_test", F.coalesce(F.struct(*place) <= F.col("__last"), F.lit(False))).drop("__g", "__last")


def seeded_sample(df: DataFrame, n: int, key: str, seed: str = "0") -> DataFrame:
    """n rows, the same ones on every run."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def majority_share(df: DataFrame, label: str) -> DataFrame:
    """(label, n, total) of the most frequent label."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0)))).orderBy(F.desc("n"), label).limit(1)


def confusion(df: DataFrame, truth: str, predicted: str, labels: Sequence) -> DataFrame:
    """A row a true label and a column a predicted one, zeros included."""
    counts = df.groupBy(F.col(truth).cast("string").alias("truth")).pivot(predicted, list(labels)).count()
    spine = df.sparkSession.createDataFrame([(str(x),) for x in labels], "truth string")
    return spine.join(counts, "truth", "left").na.fill(0)


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, support, precision, recall, f1) of each label that occurs; no cases give 0."""
    pairs = F.array(F.struct(F.col(truth).cast("string").alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p")), F.struct(F.col(predicted).cast("string").alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p")))
    hit = F.col(truth).cast("string").eqNullSafe(F.col(predicted).cast("string"))
    rows = df.select(F.explode(pairs).alias("x"), hit.alias("hit")).select("x.*", "hit").where("label is not null")
    sums = rows.groupBy("label").agg(F.sum("t").alias("support"), F.sum("p").alias("n_predicted"), F.sum(F.when(F.col("hit"), F.col("t")).otherwise(0)).alias("n_hit"))
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    return sums.select("label", "support", ratio(F.col("n_hit"), F.col("n_predicted")).alias("precision"), ratio(F.col("n_hit"), F.col("support")).alias("recall"), ratio(F.col("n_hit") * 2, F.col("support") + F.col("n_predicted")).alias("f1"))


def macro_f1(report: DataFrame) -> DataFrame:
    return report.agg(F.avg("f1").alias("macro_f1"), F.count("*").alias("n_labels"))


def gate(confidence: Column, label: Column, least: float = 0.45, manual: str = "needs manual routing") -> Column:
    """(decision, suggestion): under the least confidence a person decides, with the label as a suggestion."""
    low = confidence < least
    return F.struct(F.when(low, manual).otherwise(label).alias("decision"), F.when(low, label).alias("suggestion"))


# Fixed value: the F1 that every one of the most frequent labels must reach.
ACCEPT_F1 = 0.75


def acceptance(report: DataFrame, labels: Sequence[str], least: float = ACCEPT_F1) -> DataFrame:
    """One row (n_labels, n_passed, passed): whether each of the labels has an F1 of ``least``; one without cases has 0."""
    wanted = report.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    each = wanted.join(report.select("label", "f1"), "label", "left").select(F.coalesce("f1", F.lit(0.0)).alias("f1"))
    return each.agg(F.count("*").alias("n_labels"), F.count_if(F.col("f1") >= least).alias("n_passed")).select("n_labels", "n_passed", (F.col("n_labels") == F.col("n_passed")).alias("passed"))


def top_labels(df: DataFrame, label: str, k: int = 3) -> list[str]:
    """The k most frequent labels; equal counts go by value."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), label).limit(k).collect()]
