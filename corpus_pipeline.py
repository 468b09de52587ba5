"""A corpus made ready for training: toxic texts out, copies out, benchmark leaks out, personal data
masked, the rest encoded.

Each stage takes (spark, docs, sf_dir) and keeps the columns of its documents but for the last. Each
row is judged by its own text, whether its doc_id is null or repeated. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import copies, decontaminate, pii, stream_bpe, toxicity
from tidemark.llm.common import checkpoint, shared_path, small, table
from tidemark.sources.storage import Store

#: Keys of rows that go which may be broadcast once they have been counted.
BROADCAST_KEYS = 1_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below the operator's threshold."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, net, name="__toxicity")
    return scored.where(F.col("__toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8) the row with the smallest doc_id,
    and of those with one doc_id, or with none, the row with the smallest key; of repeated rows, one."""
    groups = checkpoint(copies.near_copies(docs))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    kept = groups.groupBy("root").agg(F.min(order).alias("least")).select(F.col("least.k").alias("__key"))
    # those that go are mostly few: then the texts stay where they are
    gone = small(checkpoint(groups.select(F.col("k").alias("__key")).distinct().join(kept, "__key", "left_anti")), BROADCAST_KEYS)
    out = docs.withColumn("__key", copies.row_key()).join(gone, "__key", "left_anti")
    if not groups.groupBy("k").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["__key"])
    return out.select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; each row is judged by its own text."""
    keyed = docs.withColumn("__key", copies.row_key())
    texts = keyed.select(F.col("__key").alias("doc_id"), "text")
    found = decontaminate.contaminated(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__key")).distinct()
    return keyed.join(found, "__key", "left_anti").select(*docs.columns)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their spans of personal data masked; n_chars follows the text."""
    clean = pii.redact(docs, pii.spans(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded)."""
    return stream_bpe.encode(docs, stream_bpe.vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("pii", mask_personal),
    ("bpe", encode),
]

#: A trained network's scores and BPE are beyond SQL. Tests hold near-dedup against all pairs and the ids
#: against the tokenizers library, plant items and personal data, and measure the scores on held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's table goes once the next one's is written, but for the last."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            Store(spark, before).delete("")
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
