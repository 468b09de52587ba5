"""Learnt operators: imputation, routing with calibrated confidence, density clustering.

Features are hashed TF-IDF of character or word n-grams, counted by MLlib on the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import build_text, char_ngrams, word_ngrams
from tidemark.functions.time import round_half_up
from tidemark.functions.vector import dot
from tidemark.operators.evaluation import ACCEPT_F1, acceptance, assert_no_leakage, class_report, fold_rare, macro_f1, temporal_split, top_labels
from tidemark.runtime import small
from tidemark.sources.storage import Store

# Labelled rows from which a model is trained, and the size under which classes are folded.
MIN_LABELLED, MIN_CLASS, OTHER = 100, 10, "__other__"
#: Fits of a router that run at a time.
FITS = 4


@dataclass(frozen=True)
class Target:
    module: str
    column: str
    texts: tuple[str, ...]


# What is imputed, and from which texts.
TARGETS = (
    Target("requests", "priority", ("subject", "short_description", "template", "group")),
    Target("requests", "group", ("subject", "short_description", "template")),
    Target("problems", "category", ("title", "description")),
    Target("problems", "priority", ("title", "description")),
)


def text_of(df: DataFrame, texts: Sequence[str]) -> Column:
    return build_text(*[F.col(c) for c in texts if c in df.columns])


def with_features(df: DataFrame, text: Column, grams: str = "char") -> DataFrame:
    made = char_ngrams(text) if grams == "char" else word_ngrams(text)
    return df.withColumn("__grams", made)


def balanced(df: DataFrame, label: str) -> DataFrame:
    """With ``__weight``: n / (classes * class size). The classes are counted once and, unless very many, broadcast: no row moves to its class."""
    sizes = small(df.groupBy(label).agg(F.count("*").alias("__n")))
    total = sizes.agg(F.struct(F.sum("__n").alias("n"), F.count("*").alias("k"))).scalar()
    weights = sizes.select(F.col(label).alias("__label"), total.alias("t"), "__n").select("__label", (F.col("t.n") / (F.col("t.k") * F.col("__n"))).alias("__weight"))
    return df.join(weights, df[label] == weights["__label"]).drop("__label")


def _stages(label: str, features: int) -> list:
    return [
        StringIndexer(inputCol=label, outputCol="__y", stringOrderType="frequencyDesc", handleInvalid="keep"),
        HashingTF(inputCol="__grams", outputCol="__tf", numFeatures=features),
        IDF(inputCol="__tf", outputCol="__idf", minDocFreq=2),
        Normalizer(inputCol="__idf", outputCol="__x"),
    ]


def train_imputer(df: DataFrame, target: Target, grams: str = "char", features: int = 1 << 15) -> PipelineModel | None:
    """A balanced logistic regression, or None with too few labelled rows or classes."""
    known = df.where(F.col(target.column).isNotNull())
    row = known.agg(F.count("*").alias("n"), F.count_distinct(target.column).alias("k")).first()
    if row.n < MIN_LABELLED or row.k < 2:
        return None
    known = with_features(fold_rare(known, target.column, MIN_CLASS, OTHER), text_of(df, target.texts), grams)
    known = balanced(known.select(F.col(target.column).cast("string").alias("__label_in"), "__grams"), "__label_in")
    fit = LogisticRegression(featuresCol="__x", labelCol="__y", weightCol="__weight", maxIter=20, regParam=1e-3, family="multinomial", probabilityCol="__prob", predictionCol="__pred", rawPredictionCol="__raw")
    return Pipeline(stages=[*_stages("__label_in", features), fit]).fit(known)


def _labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def impute(df: DataFrame, target: Target, model: PipelineModel | None, grams: str = "char") -> DataFrame:
    """The column filled in where it is null, with ``_source`` (system, predicted, missing) and ``_confidence``."""
    c = target.column
    if model is None:
        return df.withColumns({f"{c}_source": F.when(F.col(c).isNotNull(), "system").otherwise("missing"), f"{c}_confidence": F.lit(None).cast("double")})
    rows = with_features(df.withColumn("__label_in", F.col(c).cast("string")), text_of(df, target.texts), grams)
    out = PipelineModel(stages=model.stages[1:]).transform(rows)
    names = F.array(*map(F.lit, _labels(model)))
    guess = F.get(names, F.col("__pred").cast("int"))
    sure = round_half_up(F.array_max(vector_to_array("__prob")), 4)
    use = F.col(c).isNull() & (guess != OTHER)
    added = {c: F.when(use, guess).otherwise(F.col(c).cast("string")), f"{c}_source": F.when(F.col(c).isNotNull(), "system").when(use, "predicted").otherwise("missing"), f"{c}_confidence": F.when(use, sure)}
    return out.withColumns(added).select(*[x for x in df.columns], f"{c}_source", f"{c}_confidence")


def train_router(df: DataFrame, label: str, text: Column, folds: int = 3, features: int = 1 << 15) -> dict:
    """A linear support vector machine a class, with a Platt sigmoid fitted on margins of held-out folds."""
    # the rows' labels and texts are read once; all fits below start from them
    kept = df.select(F.col(label).cast("string").alias("__label_in"), text.alias("__text"), F.pmod(F.xxhash64(text), F.lit(folds)).alias("__fold")).persist()
    rows = balanced(with_features(kept, F.col("__text")).drop("__text"), "__label_in")
    prepare = Pipeline(stages=_stages("__label_in", features)).fit(rows)
    ready = prepare.transform(rows).select("__x", "__y", "__weight", "__fold").persist()
    names = _labels(prepare)
    *held_out, machines = _machines([ready.where(F.col("__fold") != f) for f in range(folds)] + [ready], len(names))
    margins = reduce(DataFrame.unionByName, [_margins(ready.where(F.col("__fold") == f), m).select("__m", "__y") for f, m in enumerate(held_out)]).persist()

    def platt(i: int) -> tuple[float, float]:
        one = VectorAssembler(inputCols=["m"], outputCol="f").transform(margins.select(F.get("__m", F.lit(i)).alias("m"), (F.col("__y") == i).cast("double").alias("y")))
        fit = LogisticRegression(featuresCol="f", labelCol="y", maxIter=50, regParam=1e-6).fit(one)
        return float(fit.coefficients[0]), float(fit.intercept)

    sigmoid = _together(platt, range(len(names)))
    for cached in (margins, ready, kept):
        cached.unpersist()
    return {"prepare": prepare, "machines": machines, "names": names, "sigmoid": sigmoid}


def save_imputer(model: PipelineModel, target: Target, folder: str) -> None:
    """Under ``module__column`` in a folder of models; one that is there is replaced."""
    model.write().overwrite().save(f"{folder}/{target.module}__{target.column}")


def load_imputer(spark: SparkSession, target: Target, folder: str) -> PipelineModel | None:
    name = f"{target.module}__{target.column}"
    return PipelineModel.load(f"{folder}/{name}") if Store(spark, folder).exists(name) else None


def enrich_module(df: DataFrame, module: str, folder: str, targets: Sequence[Target] | None = None, grams: str = "char") -> DataFrame | None:
    """Every column of the module that has a saved model filled in, in the order of the columns' names; None if none has."""
    out, touched = df, False
    for t in sorted((t for t in (TARGETS if targets is None else targets) if t.module == module), key=lambda t: t.column):
        model = load_imputer(df.sparkSession, t, folder)
        if model is not None and t.column in df.columns:
            out, touched = impute(out, t, model, grams), True
    return out if touched else None


def save_router(router: dict, spark: SparkSession, folder: str) -> None:
    """The parts of ``train_router`` in a folder; the document that names them is written last."""
    router["prepare"].write().overwrite().save(f"{folder}/prepare")
    for i, m in enumerate(router["machines"]):
        if m is not None:
            m.write().overwrite().save(f"{folder}/machine-{i}")
    Store(spark, folder).write_json("router.json", {"names": router["names"], "sigmoid": router["sigmoid"], "machines": [m is not None for m in router["machines"]]})


def load_router(spark: SparkSession, folder: str) -> dict | None:
    kept = Store(spark, folder).read_json("router.json")
    if kept is None:
        return None
    machines = [LinearSVCModel.load(f"{folder}/machine-{i}") if there else None for i, there in enumerate(kept["machines"])]
    return {"prepare": PipelineModel.load(f"{folder}/prepare"), "machines": machines, "names": kept["names"], "sigmoid": [tuple(x) for x in kept["sigmoid"]]}


def train_embedding_classifier(df: DataFrame, label: str, vector: str) -> PipelineModel:
    """A balanced logistic regression on embeddings: the alternative to n-gram features."""
    from pyspark.ml.functions import array_to_vector

    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("__label_in"), array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("__x"))
    index = StringIndexer(inputCol="__label_in", outputCol="__y", stringOrderType="frequencyDesc", handleInvalid="keep")
    fit = LogisticRegression(featuresCol="__x", labelCol="__y", weightCol="__weight", maxIter=50, regParam=1e-4, family="multinomial", probabilityCol="__prob", predictionCol="__pred", rawPredictionCol="__raw")
    return Pipeline(stages=[index, fit]).fit(balanced(rows, "__label_in"))


def classify_embeddings(df: DataFrame, model: PipelineModel, vector: str) -> DataFrame:
    """``df`` with ``predicted`` and ``confidence``."""
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("__x", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    out = PipelineModel(stages=model.stages[1:]).transform(rows)
    names = F.array(*map(F.lit, _labels(model)))
    return out.select(*df.columns, F.get(names, F.col("__pred").cast("int")).alias("predicted"), F.array_max(vector_to_array("__prob")).alias("confidence"))


def evaluate_router(df: DataFrame, label: str, time: str, key: str, texts: Sequence[str], k: int = 3, least: float = ACCEPT_F1, features: int = 1 << 15) -> dict:
    """Train on the earlier rows, test on the later ones: the router, the label report and whether each top label passes."""
    assert_no_leakage(list(texts))
    rows = temporal_split(df.where(F.col(label).isNotNull() & F.col(time).isNotNull()), time, key)
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    top = top_labels(train, label, k)
    fold = lambda d: d.withColumn("__folded", F.when(F.col(label).isin(*top), F.col(label).cast("string")).otherwise("Other"))
    router = train_router(fold(train), "__folded", text_of(df, texts), features=features)
    out = route(fold(test), router, text_of(df, texts))
    report = class_report(out, "__folded", "predicted")
    return {"router": router, "report": report, "routed": out.drop("__folded"), "acceptance": acceptance(report, top, least), "top": top, "macro": macro_f1(report)}


def _together(fit: Callable, over: Iterable) -> list:
    """Fits that don't depend on each other, ``FITS`` at a time, in their order."""
    with ThreadPool(FITS) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(fit), over)


def _machines(sets: list[DataFrame], classes: int) -> list[list]:
    """For each set of rows a linear support vector machine for each class against the rest; None where the rows have only one side."""
    there = _together(lambda rows: {int(r["__y"]) for r in rows.select("__y").distinct().collect()}, sets)  # as many rows as classes

    def fit(which: tuple[int, int]):
        k, i = which
        if i not in there[k] or len(there[k]) < 2:
            return None
        svm = LinearSVC(featuresCol="__x", labelCol="__one", weightCol="__weight", rawPredictionCol=f"__raw{i}", predictionCol=f"__pred{i}", maxIter=8, regParam=1e-3)
        return svm.fit(sets[k].withColumn("__one", (F.col("__y") == i).cast("double")))

    made = _together(fit, [(k, i) for k in range(len(sets)) for i in range(classes)])
    return [made[k * classes : (k + 1) * classes] for k in range(len(sets))]


def _margins(df: DataFrame, machines: list) -> DataFrame:
    """With ``__m``: the margins of all classes, -1 where there is no machine."""
    for m in machines:
        df = m.transform(df) if m is not None else df
    margin = lambda m: F.lit(-1.0) if m is None else F.get(vector_to_array(m.getRawPredictionCol()), F.lit(1))
    return df.withColumn("__m", F.array(*map(margin, machines)))


def route(df: DataFrame, router: dict, text: Column) -> DataFrame:
    """``df`` with ``predicted`` and ``confidence``: the calibrated shares of the classes add up to 1."""
    rows = _margins(PipelineModel(stages=router["prepare"].stages[1:]).transform(with_features(df, text)), router["machines"])
    p = F.array(*[1 / (1 + F.exp(-(F.get("__m", F.lit(i)) * a + b))) for i, (a, b) in enumerate(router["sigmoid"])])
    rows = rows.withColumn("__p", p)
    total = F.aggregate("__p", F.lit(0.0), lambda s, x: s + x)
    best = F.array_max("__p")
    names = F.array(*map(F.lit, router["names"]))
    return rows.select(*df.columns, F.get(names, F.array_position("__p", best).cast("int") - 1).alias("predicted"), (best / total).alias("confidence"))


def cross_lingual_gate(pairs: DataFrame) -> DataFrame:
    """(probe, own, best_other, passed) of pairs (probe, a, b): do a and b agree more with each other than with other pairs' means?"""
    left = pairs.select("probe", F.col("a").alias("a"), F.col("b").alias("b"))
    means = pairs.select(F.col("probe").alias("other"), F.zip_with("a", "b", lambda x, y: (x.cast("double") + y.cast("double")) / 2).alias("m"))
    others = left.join(means, F.col("probe") != F.col("other")).groupBy("probe").agg(F.max(F.greatest(dot(F.col("a"), F.col("m")), dot(F.col("b"), F.col("m")))).alias("best_other"))
    own = left.select("probe", dot(F.col("a"), F.col("b")).alias("own"))
    return own.join(others, "probe").select("probe", "own", "best_other", (F.col("own") > F.col("best_other")).alias("passed"))


def save_metrics(spark: SparkSession, metrics: list[dict], folder: str, name: str = "metrics.json") -> None:
    """Metrics by (module, column) as a JSON document; those of the same key are replaced."""
    store = Store(spark, folder)
    known = {(m["module"], m["column"]): m for m in store.read_json(name) or []} | {(m["module"], m["column"]): m for m in metrics}
    store.write_json(name, [known[k] for k in sorted(known)])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The latest row of each key by ``order``; at a tie the new one. One row a key leaves each task."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in old.columns if c not in keys]), F.struct(order, "__new")).alias("__last"))
    return best.select(*[F.col(c) if c in keys else F.col("__last")[c].alias(c) for c in old.columns])
