"""Queries on orders as tickets (status F is closed, made on the order's date), and on documents with labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import has_resolution
from tidemark.operators import analytics as A
from tidemark.operators import evaluation as E
from tidemark.plans.registry import query, table

_RULE = "CASE WHEN contains(text, '!!') OR contains(text, '%%%') OR contains(text, '|') THEN 0 ELSE 1 END"


def _labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    "kpi_overview",
    """SELECT count(*) AS total, count(*) - count(*) FILTER (o_orderstatus = 'F') AS open,
       count(*) FILTER (o_orderstatus = 'F') * 100.0::DOUBLE / count(*) AS closed_pct,
       count(*) FILTER (o_orderpriority = '1-URGENT') * 100.0::DOUBLE / count(*) AS overdue_pct,
       count(DISTINCT o_orderpriority) AS n_groups
       FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31' + INTERVAL 1 DAY""",
)
def kpi_overview(spark, sf):
    rows = A.filter_rows(table(spark, sf, "orders"), {}, "o_orderdate", "1996-01-01", "2000-12-31")
    return A.kpis(rows, "o_orderstatus", F.col("o_orderpriority") == "1-URGENT", "o_orderpriority", closed=("F",)).drop("mean_hours")


@query(
    "resolution_hours",
    """WITH closed AS (SELECT o_orderkey, o_orderpriority, o_orderdate, max(l_shipdate) AS closed_at FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
       h AS (SELECT o_orderpriority, (epoch_ms(closed_at) - epoch_ms(o_orderdate)) / 3600000.0::DOUBLE AS hours FROM closed WHERE closed_at >= o_orderdate)
       SELECT o_orderpriority, count(*) AS n, CAST(sum(hours) AS DOUBLE) / count(*) AS mean_hours, max(hours) AS max_hours FROM h GROUP BY 1""",
)
def resolution_hours(spark, sf):
    from tidemark.functions.time import hours_between

    closed = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed_at"))
    rows = table(spark, sf, "orders").join(closed, F.col("o_orderkey") == F.col("l_orderkey")).where("closed_at >= o_orderdate")
    hours = rows.select("o_orderpriority", hours_between(F.col("o_orderdate"), F.col("closed_at")).alias("hours"))
    return hours.groupBy("o_orderpriority").agg(F.count("*").alias("n"), (F.sum("hours") / F.count("*")).alias("mean_hours"), F.max("hours").alias("max_hours"))


@query("top_counts_priority", "SELECT coalesce(o_orderpriority, '—') AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 12")
def top_counts_priority(spark, sf):
    return A.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("top_counts_null_fill", "SELECT coalesce(CAST(quality AS VARCHAR), '—') AS value, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1 ORDER BY n DESC, value LIMIT 12")
def top_counts_null_fill(spark, sf):
    return A.value_counts(_labelled(spark, sf), "quality")


@query(
    "top_counts_all_fields",
    """WITH p AS (SELECT 'lang' AS field, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents),
       c AS (SELECT field, value, count(*) AS n FROM p GROUP BY ALL)
       SELECT field, value, n FROM c QUALIFY row_number() OVER (PARTITION BY field ORDER BY n DESC, value) <= 12""",
)
def top_counts_all_fields(spark, sf):
    return A.value_counts_all(table(spark, sf, "documents"), ["lang", "source", "absent"])


@query(
    "filter_requests_multi",
    """SELECT n_name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderstatus IN ('F', 'O') AND c_mktsegment IN ('BUILDING', 'MACHINERY')
       AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1999-06-30' + INTERVAL 1 DAY GROUP BY 1""",
)
def filter_requests_multi(spark, sf):
    orders = A.filter_rows(table(spark, sf, "orders"), {"o_orderstatus": ["F", "O"]}, "o_orderdate", "1997-01-01", "1999-06-30")
    customers = A.filter_rows(table(spark, sf, "customer"), {"c_mktsegment": ["BUILDING", "MACHINERY"], "c_name": []})
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))


@query("filter_picker_values", "SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL ORDER BY 1")
def filter_picker_values(spark, sf):
    return A.distinct_sorted(table(spark, sf, "customer"), "c_mktsegment")


@query(
    "label_null_pct",
    """WITH r AS (SELECT count(*) AS n, count(*) FILTER (quality IS NULL) AS q, count(*) FILTER (lang IS NULL) AS l FROM documents LEFT JOIN labels USING (doc_id)),
       p AS (SELECT 'quality' AS field, floor(q * 100.0::DOUBLE / n * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS null_pct FROM r UNION ALL SELECT 'lang', floor(l * 100.0::DOUBLE / n * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE FROM r)
       SELECT field, null_pct, null_pct >= 40 AS weak FROM p""",
)
def label_null_pct(spark, sf):
    return A.null_shares(_labelled(spark, sf), ["quality", "lang", "absent"])


@query(
    "provenance_split",
    """WITH r AS (SELECT lang, CASE WHEN quality IS NULL THEN 'predicted' ELSE 'system' END AS src FROM documents LEFT JOIN labels USING (doc_id))
       SELECT lang, count(*) FILTER (src <> 'predicted') AS kept, count(*) FILTER (src = 'predicted') AS excluded FROM r GROUP BY 1""",
)
def provenance_split(spark, sf):
    rows = _labelled(spark, sf).withColumn("quality_source", F.when(F.col("quality").isNull(), "predicted").otherwise("system"))
    kept, _ = A.split_predicted(rows, "quality_source")
    counts = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    return rows.groupBy("lang").agg(F.count_if(F.col("quality_source") == "predicted").alias("excluded")).join(counts, "lang", "left").na.fill(0)


@query(
    "histogram_length",
    """WITH e AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
       c AS (SELECT CAST(least(floor((n_chars::DOUBLE - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n FROM documents, e GROUP BY 1)
       SELECT CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(30) t(b) LEFT JOIN c ON b = bin""",
)
def histogram_length(spark, sf):
    return A.histogram(table(spark, sf, "documents"), "n_chars")


@query(
    "target_recommendation",
    """WITH r AS (SELECT count(*) FILTER (quality IS NULL) * 100.0::DOUBLE / count(*) AS group_null_pct, count(DISTINCT quality) AS n_groups,
       count(*) FILTER (toxic = 1) / count(*)::DOUBLE AS overdue_rate FROM documents LEFT JOIN labels USING (doc_id))
       SELECT *, group_null_pct < 40 AND n_groups >= 2 AS routing_viable, overdue_rate > 0.05 AND overdue_rate < 0.95 AS overdue_viable FROM r""",
)
def target_recommendation(spark, sf):
    return A.recommend(_labelled(spark, sf), "quality", F.col("toxic") == 1)


@query("dedup_copies", "SELECT md5(text) AS h, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def dedup_copies(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    return rows.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("dedup_first", "SELECT doc_id, lang, source, md5(text) AS h FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def dedup_first(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", F.md5("text").alias("h"))
    return A.first_per_key(rows, ["h"], ["doc_id"])


@query(
    "fold_topk",
    """WITH t AS (SELECT o_orderpriority AS p FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
       SELECT CASE WHEN o_orderpriority IN (SELECT p FROM t) THEN o_orderpriority ELSE 'Other' END AS label, count(*) AS n FROM orders GROUP BY 1""",
)
def fold_topk(spark, sf):
    rows = E.fold_top(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("label")), "label")
    return rows.groupBy("label").agg(F.count("*").alias("n"))


@query(
    "fold_rare",
    """WITH c AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1)
       SELECT CASE WHEN k < 10 THEN '__other__' ELSE CAST(o_custkey AS VARCHAR) END AS label, count(*) AS n FROM orders JOIN c USING (o_custkey) GROUP BY 1""",
)
def fold_rare(spark, sf):
    rows = E.fold_rare(table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("label")), "label", 10)
    return rows.groupBy("label").agg(F.count("*").alias("n"))


@query(
    "temporal_split",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) AS i, count(*) OVER () AS n FROM orders)
       SELECT o_orderkey, i > n * 4 // 5 AS is_test FROM r""",
)
def temporal_split(spark, sf):
    return E.temporal_split(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey").select("o_orderkey", "is_test")


@query(
    "temporal_split_rows",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) AS i, count(*) OVER () AS n FROM orders)
       SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, i > n * 4 // 5 AS is_test FROM r""",
)
def temporal_split_rows(spark, sf):
    return E.temporal_split(table(spark, sf, "orders"), "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "is_test")


@query(
    "stratified_split",
    """WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('0:' || CAST(doc_id AS VARCHAR)), doc_id) AS i, count(*) OVER (PARTITION BY quality) AS n FROM labels)
       SELECT doc_id, quality, i <= n // 5 AS is_test FROM r""",
)
def stratified_split(spark, sf):
    return E.stratified_split(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("seeded_sample", "SELECT doc_id FROM documents ORDER BY md5('0:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 50")
def seeded_sample(spark, sf):
    return E.seeded_sample(table(spark, sf, "documents").select("doc_id"), 50, "doc_id")


@query("majority_baseline", "WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1) SELECT quality, n, CAST((SELECT sum(n) FROM c) AS BIGINT) AS total FROM c ORDER BY n DESC, quality LIMIT 1")
def majority_baseline(spark, sf):
    return E.majority_share(table(spark, sf, "labels"), "quality")


def _predicted(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    noisy = F.col("text").contains("!!") | F.col("text").contains("%%%") | F.col("text").contains("|")
    return rows.select("quality", F.when(noisy, 0).otherwise(1).alias("pred"))


@query(
    "confusion_matrix",
    f"""WITH r AS (SELECT quality, {_RULE} AS pred FROM documents JOIN labels USING (doc_id))
       SELECT CAST(quality AS VARCHAR) AS truth, count(*) FILTER (pred = 0) AS "0", count(*) FILTER (pred = 1) AS "1" FROM r GROUP BY 1""",
)
def confusion_matrix(spark, sf):
    return E.confusion(_predicted(spark, sf), "quality", "pred", [0, 1])


@query(
    "class_report",
    f"""WITH r AS (SELECT quality AS t, {_RULE} AS p FROM documents JOIN labels USING (doc_id)),
       l AS (SELECT unnest([0, 1]) AS label),
       s AS (SELECT CAST(label AS VARCHAR) AS label, CAST(count(*) FILTER (t = label) AS BIGINT) AS support, count(*) FILTER (p = label) AS np, count(*) FILTER (t = label AND p = label) AS nh FROM l, r GROUP BY 1)
       SELECT label, support, CASE WHEN np = 0 THEN 0 ELSE nh / np::DOUBLE END AS "precision", CASE WHEN support = 0 THEN 0 ELSE nh / support::DOUBLE END AS recall,
       CASE WHEN support + np = 0 THEN 0 ELSE nh * 2 / (support + np)::DOUBLE END AS f1 FROM s""",
)
def class_report(spark, sf):
    return E.class_report(_predicted(spark, sf), "quality", "pred")


@query(
    "confidence_gate",
    """WITH r AS (SELECT event_id, event_type, value / 100.0::DOUBLE AS confidence FROM events)
       SELECT event_id, CASE WHEN confidence < 0.45 THEN 'needs manual routing' ELSE event_type END AS decision, CASE WHEN confidence < 0.45 THEN event_type END AS suggestion FROM r""",
)
def confidence_gate(spark, sf):
    rows = table(spark, sf, "events").select("event_id", E.gate(F.col("value") / 100.0, F.col("event_type")).alias("g"))
    return rows.select("event_id", "g.decision", "g.suggestion")


@query(
    "cluster_summary",
    """WITH v AS (SELECT vec_id, CASE WHEN label = 0 THEN -1 ELSE label END AS cluster FROM embeddings),
       j AS (SELECT cluster, lang, source FROM v JOIN documents ON vec_id = doc_id WHERE cluster <> -1),
       m AS (SELECT cluster, lang AS top_lang FROM j GROUP BY cluster, lang QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, lang) = 1),
       s AS (SELECT cluster, source AS top_source FROM j GROUP BY cluster, source QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, source) = 1)
       SELECT cluster, count(*) AS n, any_value(top_lang) AS top_lang, any_value(top_source) AS top_source FROM j JOIN m USING (cluster) JOIN s USING (cluster) GROUP BY 1 ORDER BY n DESC, cluster LIMIT 10""",
)
def cluster_summary(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("cluster"))
    return A.cluster_summary(v.join(table(spark, sf, "documents"), F.col("vec_id") == F.col("doc_id")), "cluster", ["lang", "source"])


@query("noise_share", "SELECT count(*) AS n, count(*) FILTER (label = 0) AS n_noise, count(DISTINCT label) FILTER (label <> 0) AS n_clusters FROM embeddings")
def noise_share(spark, sf):
    return A.noise_share(table(spark, sf, "embeddings").select(F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("cluster")), "cluster")


@query(
    "metrics_upsert",
    """WITH b AS (SELECT user_id, event_type, ts, event_id, event_id % 2 AS fresh FROM events)
       SELECT user_id, event_type, event_id FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, fresh DESC) = 1""",
)
def metrics_upsert(spark, sf):
    from tidemark.operators.models import upsert

    rows = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return upsert(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), ["user_id", "event_type"], "ts").drop("ts")


@query(
    "problem_metrics",
    """SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS resolved, count(*) FILTER (o_custkey >= 1000) * 100.0::DOUBLE / count(*) AS usable_pct FROM orders""",
)
def problem_metrics(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderstatus", has_resolution(F.col("o_custkey").cast("string")).alias("usable"))
    return A.problem_metrics(rows, "o_orderstatus", "usable", closed=("F",))


@query("time_range", "SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events")
def time_range(spark, sf):
    return A.time_range(table(spark, sf, "events"), "ts")


@query("display_columns", "SELECT lang AS \"Language\", count(*) AS \"Documents\" FROM documents GROUP BY 1")
def display_columns(spark, sf):
    counts = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return A.renamed(counts, {"lang": "Language", "n": "Documents", "absent": "Absent"})


@query(
    "routing_acceptance",
    f"""WITH r AS (SELECT quality AS t, {_RULE} AS p FROM documents JOIN labels USING (doc_id)), l AS (SELECT unnest([0, 1, 2]) AS label),
       s AS (SELECT label, count(*) FILTER (t = label) AS support, count(*) FILTER (p = label) AS np, count(*) FILTER (t = label AND p = label) AS nh FROM l, r GROUP BY 1),
       f AS (SELECT CASE WHEN support + np = 0 THEN 0 ELSE nh * 2 / (support + np)::DOUBLE END AS f1 FROM s)
       SELECT count(*) AS n_labels, count(*) FILTER (f1 >= 0.75) AS n_passed, count(*) = count(*) FILTER (f1 >= 0.75) AS passed FROM f""",
)
def routing_acceptance(spark, sf):
    return E.acceptance(E.class_report(_predicted(spark, sf), "quality", "pred"), ["0", "1", "2"])
