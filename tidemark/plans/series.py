"""Queries on daily series: events by type, orders by priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.time import parse_epoch, time_features, to_datetime
from tidemark.operators import series as S
from tidemark.plans.registry import query, table

_DAILY = """d AS (SELECT event_type, CAST(ts AS DATE) AS ds, count(*) AS y FROM events GROUP BY ALL),
  e AS (SELECT event_type, min(ds) AS lo, max(ds) AS hi FROM d GROUP BY 1),
  s AS (SELECT event_type, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM e),
  f AS (SELECT event_type, ds, coalesce(y, 0) AS y FROM s LEFT JOIN d USING (event_type, ds))"""


@query(
    "volume_daily",
    """WITH d AS (SELECT date_trunc('day', ts)::TIMESTAMP AS bucket, count(*) AS n FROM events GROUP BY 1)
       SELECT b AS bucket, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 DAY)) AS b FROM d) LEFT JOIN d ON b = bucket""",
)
def volume_daily(spark, sf):
    return S.volume(table(spark, sf, "events"), "ts")


@query(
    "volume_monthly",
    """WITH d AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS bucket, count(*) AS n FROM orders GROUP BY 1)
       SELECT b AS bucket, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 MONTH)) AS b FROM d) LEFT JOIN d ON b = bucket""",
)
def volume_monthly(spark, sf):
    return S.volume(table(spark, sf, "orders"), "o_orderdate", "M")


@query("volume_by_group", f"WITH {_DAILY} SELECT event_type, ds, y FROM f")
def volume_by_group(spark, sf):
    return S.daily_volume(table(spark, sf, "events"), "ts", ["event_type"])


@query("weekday_pattern", f"WITH {_DAILY} SELECT event_type, CAST(isodow(ds) - 1 AS INTEGER) AS weekday, count(*) AS days, CAST(sum(y) AS BIGINT) AS total FROM f GROUP BY ALL")
def weekday_pattern(spark, sf):
    return S.weekday_means(S.daily_volume(table(spark, sf, "events"), "ts", ["event_type"]), ["event_type"])


@query(
    "monthly_trend",
    """WITH m AS (SELECT c_mktsegment AS g, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
       r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY m DESC) AS back FROM m),
       a AS (SELECT g, count(*) AS months, avg(n) FILTER (back <= 3) AS recent, avg(n) FILTER (back > 3) AS earlier FROM r GROUP BY 1)
       SELECT g AS c_mktsegment, months, CASE WHEN months < 3 THEN 'insufficient history' WHEN recent > earlier * 1.25 THEN 'rising' WHEN recent < earlier * 0.75 THEN 'falling' ELSE 'stable' END AS trend FROM a""",
)
def monthly_trend(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return S.monthly_trend(rows, "o_orderdate", ["c_mktsegment"])


_NAIVE = """o AS (SELECT o_orderpriority AS g, CAST(o_orderdate AS DATE) AS ds, count(*) AS y FROM orders GROUP BY ALL),
  e AS (SELECT g, min(ds) AS lo, max(ds) AS hi FROM o GROUP BY 1),
  s AS (SELECT g, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM e),
  f AS (SELECT g, ds, coalesce(y, 0) AS y, row_number() OVER (PARTITION BY g ORDER BY ds DESC) AS back FROM s LEFT JOIN o USING (g, ds))"""


@query(
    "naive_forecast",
    f"""WITH {_NAIVE}, w AS (SELECT g, 8 - back AS pos, y FROM f WHERE back <= 7)
       SELECT g AS o_orderpriority, CAST(t AS INTEGER) AS step, y::DOUBLE AS yhat FROM w JOIN range(1, 29) r(t) ON (t - 1) % 7 + 1 = pos""",
)
def naive_forecast(spark, sf):
    return S.naive_forecast(S.daily_volume(table(spark, sf, "orders"), "o_orderdate", ["o_orderpriority"]), 28, ["o_orderpriority"])


@query(
    "mape_eval",
    f"""WITH {_NAIVE}, w AS (SELECT g, 36 - back AS pos, y FROM f WHERE back BETWEEN 29 AND 35),
       t AS (SELECT g, 29 - back AS step, y FROM f WHERE back <= 28),
       p AS (SELECT t.g, abs(t.y - w.y::DOUBLE) / greatest(t.y::DOUBLE, 1.0::DOUBLE) AS ape FROM t JOIN w ON t.g = w.g AND (step - 1) % 7 + 1 = pos)
       SELECT g AS o_orderpriority, count(*) AS days, round(avg(ape), 9) AS mape FROM p GROUP BY 1""",
)
def mape_eval(spark, sf):
    daily = S.daily_volume(table(spark, sf, "orders"), "o_orderdate", ["o_orderpriority"])
    return S.evaluate_naive(daily, ["o_orderpriority"]).withColumn("mape", F.round("mape", 9))


_HOLIDAYS = ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in [("ramadan", a, b) for a, b in S.RAMADAN] + [(n, d, d) for n, ds in S.HOLIDAYS.items() for d in ds])


@query(
    "holiday_calendar",
    f"""WITH h(holiday, a, b) AS (VALUES {_HOLIDAYS}), e AS (SELECT holiday, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS o FROM h)
       , c AS (SELECT holiday, CAST(o + INTERVAL 1 DAY * d AS DATE) AS ds, CAST(d AS INTEGER) AS day FROM e, range(2) r(d)),
       n AS (SELECT CAST(o_orderdate + INTERVAL 25 YEAR AS DATE) AS ds, count(*) AS y FROM orders GROUP BY 1)
       SELECT holiday, c.ds AS ds, day, CAST(coalesce(y, 0) AS BIGINT) AS y FROM c LEFT JOIN n ON n.ds = c.ds""",
)
def holiday_calendar(spark, sf):
    """How much there was on each holiday and the day after it, of the orders 25 years on."""
    later = table(spark, sf, "orders").select(F.add_months(F.col("o_orderdate").cast("date"), 25 * 12).alias("at"))
    return S.on_holidays(S.daily_volume(later, "at"))


@query("time_features", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS created_hour, CAST(isodow(ts) - 1 AS INTEGER) AS created_dayofweek, CAST(month(ts) AS INTEGER) AS created_month FROM events")
def time_features_query(spark, sf):
    made = time_features(F.col("ts"))
    return table(spark, sf, "events").select("event_id", *[made[k].alias(k) for k in ("created_hour", "created_dayofweek", "created_month")])


@query("epoch_parse", "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS parsed, CAST(NULL AS TIMESTAMP) AS bad FROM events")
def epoch_parse(spark, sf):
    text = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf, "events").select("event_id", parse_epoch(text).alias("parsed"), parse_epoch(F.concat(F.lit("x"), text)).alias("bad"))


@query("coerced_datetime", "SELECT event_id, ts::TIMESTAMP AS parsed, CAST(NULL AS TIMESTAMP) AS bad, date_trunc('day', ts)::TIMESTAMP AS day FROM events")
def coerced_datetime(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select("event_id", to_datetime(ts.cast("string")).alias("parsed"), to_datetime(F.concat(F.lit("x"), ts.cast("string"))).alias("bad"), to_datetime(F.date_format(ts, "dd/MM/yyyy")).alias("day"))


@query("forecast_seasonal")
def forecast_seasonal(spark, sf):
    return S.seasonal_forecast(S.daily_volume(table(spark, sf, "orders"), "o_orderdate", ["o_orderpriority"]), "o_orderpriority")


@query("forecast_verdict")
def forecast_verdict(spark, sf):
    return S.evaluate_seasonal(S.daily_volume(table(spark, sf, "orders"), "o_orderdate", ["o_orderpriority"]), "o_orderpriority")


@query(
    "volume_all_and_teams",
    """WITH r AS (SELECT o_orderpriority AS g, CAST(o_orderdate AS DATE) AS ds FROM orders WHERE o_orderdate IS NOT NULL),
       t AS (SELECT g FROM r WHERE g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 3),
       d AS (SELECT 'ALL' AS k, ds, count(*) AS y FROM r GROUP BY ds UNION ALL SELECT g, ds, count(*) FROM r WHERE g IN (SELECT g FROM t) GROUP BY g, ds),
       s AS (SELECT k, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM (SELECT k, min(ds) AS lo, max(ds) AS hi FROM d GROUP BY k))
       SELECT s.k AS "group", s.ds AS ds, CAST(coalesce(d.y, 0) AS BIGINT) AS y FROM s LEFT JOIN d ON d.k = s.k AND d.ds = s.ds""",
)
def volume_all_and_teams(spark, sf):
    return S.daily_with_all(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority")


@query("forecast_all_and_teams")
def forecast_all_and_teams(spark, sf):
    return S.forecast_teams(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority")
