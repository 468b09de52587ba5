"""Queries that learn: their rows depend on fitted models, so they have no SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.vector import hashed_embedding
from tidemark.operators import models as M
from tidemark.operators.density import density_clusters
from tidemark.operators.evaluation import temporal_split
from tidemark.operators.manifold import embed_manifold
from tidemark.plans.registry import query, table


@query("cluster_density")
def cluster_density(spark, sf):
    rows = embed_manifold(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"), "vec_id", "embedding", 10)
    return density_clusters(rows, "vec_id", "embedding").select("vec_id", "label", "cluster")


@query("impute_quality")
def impute_quality(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality")), "doc_id", "left")
    target = M.Target("documents", "quality", ("text",))
    return M.impute(rows, target, M.train_imputer(rows, target, grams="word"), grams="word").drop("text")


@query("classify_embedded")
def classify_embedded(spark, sf):
    """The embedding alternative: quality from the vectors of texts, learnt from three quarters of the rows."""
    rows = table(spark, sf, "documents").select("doc_id", hashed_embedding(F.col("text")).alias("v")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = rows.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    model = M.train_embedding_classifier(rows.where("not held_out"), "quality", "v")
    return M.classify_embeddings(rows, model, "v").select("doc_id", "held_out", "quality", "predicted", "confidence")


@query("route_language")
def route_language(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"))
    rows = temporal_split(pages, "page_id", "page_id")
    router = M.train_router(rows.where(~F.col("is_test")), "lang", F.col("title"))
    return M.route(rows.where("is_test"), router, F.col("title")).select("page_id", "lang", "predicted", "confidence")
