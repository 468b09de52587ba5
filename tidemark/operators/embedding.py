"""Embeddings of texts, kept by content, so that a text is embedded once by each model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vector import MODEL, cache_key, hashed_embedding
from tidemark.runtime import ship
from tidemark.sources.storage import Store


def embedded(df: DataFrame, text: Column, cache: str | None = None, model: str = MODEL, embed: Callable[[Column], Column] = hashed_embedding, name: str = "embedding") -> DataFrame:
    """``df`` with the embedding of each row's text.

    With a cache, a folder of Parquet files (key, vector), only texts without an entry are embedded,
    each once, and added to it; the key is a hash of model and text.
    """
    spark = df.sparkSession
    ship(spark)
    if cache is None:
        return df.withColumn(name, embed(text))
    keyed = df.withColumn("__key", cache_key(text, model)).withColumn("__text", text)
    known = spark.read.parquet(cache) if Store(spark, cache).exists() else spark.createDataFrame([], "key string, vector array<float>")
    todo = keyed.groupBy("__key").agg(F.any_value("__text").alias("t")).join(known, F.col("__key") == F.col("key"), "left_anti")
    todo.select(F.col("__key").alias("key"), embed(F.col("t")).alias("vector")).write.mode("append").parquet(cache)
    vectors = spark.read.parquet(cache).dropDuplicates(["key"]).select(F.col("key").alias("__k"), F.col("vector").alias(name))
    return keyed.join(vectors, F.col("__key") == F.col("__k"), "left").drop("__key", "__k", "__text")
