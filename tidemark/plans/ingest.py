"""Queries that put tables into the shape of landed JSON and flatten it again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.nested import list_size, parsed, pick
from tidemark.plans.registry import query, table
from tidemark.sources import files, landing
from tidemark.sources import tables as B


@query("json_pick", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS name FROM events")
def json_pick(spark, sf):
    v = parsed(F.col("props"))
    return table(spark, sf, "events").select("event_id", pick(v, "k").alias("k"), pick(v).alias("name"))


@query("notes_count", "SELECT conv_id, CAST(count(*) AS INTEGER) AS notes_count FROM conversations GROUP BY 1")
def notes_count(spark, sf):
    notes = table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role")).alias("notes"))).alias("j"))
    return notes.select("conv_id", list_size(F.try_variant_get(parsed(F.col("j")), "$.notes", "variant")).alias("notes_count"))


def _ref(c):
    return F.struct(c.alias("name"))


def _time(c):
    return F.struct(F.unix_millis(c.cast("timestamp")).cast("string").alias("value"), c.cast("string").alias("display_value"))


def _pages(spark, sf, module: str, records):
    """Records as pages of about 100, in the shape in which they land."""
    rows = records.select((F.col("n") / 100).cast("long").alias("page"), "n", F.to_json("r").alias("r"))
    each = rows.groupBy("page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "r"))), lambda x: x["r"]), ",").alias("rs"))
    return each.select(F.format_string("page_%08d.json", "page").alias("file"), F.concat(F.lit('{"list_info":{"has_more_rows":false},"' + module + '":['), "rs", F.lit("]}")).alias("value"))


@query(
    "flatten_requests",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS subject, o_orderstatus AS status, o_orderdate::TIMESTAMP AS created_time, c_name AS requester_name, n_name AS requester_site,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS created_dayofweek, CAST(length(o_orderpriority) AS INTEGER) AS subject_len, o_orderstatus = 'F' AS is_overdue
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def flatten_requests(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    who = F.struct(F.col("c_name").alias("name"), F.struct(F.struct(F.col("n_name").alias("name")).alias("site")).alias("department"))
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("subject"), _ref(F.col("o_orderstatus")).alias("status"), _time(F.col("o_orderdate")).alias("created_time"), who.alias("requester"), (F.col("o_orderstatus") == "F").alias("is_overdue"))
    pages = _pages(spark, sf, "requests", rows.select(F.col("o_orderkey").alias("n"), record.alias("r")))
    flat = B.build(files.page_records(pages, "requests"), "requests")
    return flat.select("id", "subject", "status", "created_time", "requester_name", "requester_site", "created_dayofweek", "subject_len", "is_overdue")


@query(
    "flatten_problems",
    """WITH c AS (SELECT l_orderkey, max(l_shipdate) AS closed FROM lineitem GROUP BY 1)
       SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderstatus AS status, closed::TIMESTAMP AS closed_time,
       floor((epoch_ms(closed) - epoch_ms(o_orderdate)) / 3600000.0::DOUBLE * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS resolution_hours,
       o_custkey >= 1000 AS has_resolution, o_custkey < 1000 AS resolution_is_junk FROM orders JOIN c ON o_orderkey = l_orderkey""",
)
def flatten_problems(spark, sf):
    closed = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    rows = table(spark, sf, "orders").join(closed, F.col("o_orderkey") == F.col("l_orderkey"))
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"), _ref(F.col("o_orderstatus")).alias("status"), _time(F.col("o_orderdate")).alias("reported_time"), _time(F.col("closed")).alias("closed_time"), F.col("o_custkey").cast("string").alias("resolution"))
    pages = _pages(spark, sf, "rows", rows.select(F.col("o_orderkey").alias("n"), record.alias("r")))
    flat = B.build(files.page_records(pages, "problems"), "problems")
    return flat.select("id", "title", "status", "closed_time", "resolution_hours", "has_resolution", "resolution_is_junk")


@query(
    "flatten_generic",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand, CAST(p_size AS VARCHAR) AS size, CAST(2 AS INTEGER) AS tags_count, CAST(p_partkey AS VARCHAR) AS "owner", make_timestamp(CAST(p_partkey AS BIGINT) * 1000000) AS made FROM part""",
)
def flatten_generic(spark, sf):
    record = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), _ref(F.col("p_brand")).alias("brand"), F.col("p_size").alias("size"), F.array("p_type", "p_brand").alias("tags"),
        F.struct(F.col("p_partkey").cast("string").alias("id")).alias("owner"), F.struct((F.col("p_partkey") * 1000).cast("string").alias("value"), F.lit("x").alias("display_value")).alias("made"),
    )
    pages = _pages(spark, sf, "categories", table(spark, sf, "part").select(F.col("p_partkey").alias("n"), record.alias("r")))
    return B.build(files.page_records(pages, "categories"), "categories")


@query(
    "enrich_details",
    """WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
       SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c AS INTEGER) AS notes_count, CAST(CASE WHEN c IS NULL THEN NULL ELSE 1 END AS INTEGER) AS attachments_count, o_orderpriority AS description, CASE WHEN c IS NULL THEN NULL ELSE o_orderstatus || ' done' END AS resolution
       FROM orders LEFT JOIN n ON o_orderkey = l_orderkey""",
)
def enrich_details(spark, sf):
    orders = table(spark, sf, "orders")
    notes = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber")).alias("n"))
    rows = orders.join(notes, F.col("o_orderkey") == F.col("l_orderkey"))
    content = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('{"content":"'), "o_orderstatus", F.lit(' <b>done</b>"}'))).otherwise(F.concat(F.lit('"'), "o_orderstatus", F.lit(' done"')))
    bundle = F.concat(F.lit('{"detail":{"request":{"description":"","attachments":[1],"resolution":'), content, F.lit('}},"notes":'), F.to_json(F.struct(F.col("n").alias("notes"))), F.lit("}"))
    details = rows.select(F.col("o_orderkey").cast("string").alias("id"), F.parse_json(bundle).alias("bundle"))
    flat = orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("description"))
    return B.enrich(flat, details, "requests")


@query("resumable_ids", "SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resumable_ids(spark, sf):
    landed = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"))
    return landing.missing(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), landed)
