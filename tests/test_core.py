"""Scalars, series, splits, sources and jobs against values worked out by hand."""

import datetime as dt
import json
import os
import threading
import time as clock
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.functions import nested, privacy, text, time, vector
from tidemark.operators import analytics, embedding, evaluation, jobs, models, retrieval, series
from tidemark.sources import files, landing, rest, tables
from tidemark.sources.storage import Store
from tidemark.streaming import ingest


def values(spark, fn, given, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_language(spark):
    given = [None, "", "123", "abc", "مرحبا", "abc مرحبا", "VPN لا يعمل من المنزل الآن", "abc" + "م" * 17, "مabcdefghi", "٣"]
    assert values(spark, text.detect_lang, given) == ["unknown", "unknown", "unknown", "en", "ar", "mixed", "ar", "ar", "en", "ar"]


def test_junk_and_resolution(spark):
    given = ["10", " 16 ", "1000", "", None, "تم", "١٠"]
    assert values(spark, text.is_junk, given) == [True, True, False, False, False, False, True]
    assert values(spark, text.has_resolution, [None, "", "10", "Replaced cable"]) == [False, False, False, True]


def test_coercions(spark):
    given = ["2024-01-02 03:04:05", "02/01/2024 03:04", "2024/01/02", "nonsense", None]
    assert values(spark, time.to_datetime, given) == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4), dt.datetime(2024, 1, 2), None, None]
    assert values(spark, text.not_blank, [" x ", " \u00a0", "", None]) == [True, False, False, False]
    assert values(spark, lambda c: text.truncate(c, 2), ["abc", "a", None]) == ["ab", "a", None]


def test_epoch_and_features(spark):
    assert values(spark, time.parse_epoch, [None, "", "abc", "0", "1700000000123"]) == [None, None, None, dt.datetime(1970, 1, 1), dt.datetime(2023, 11, 14, 22, 13, 20, 123000)]
    row = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' a, TIMESTAMP_NTZ '2024-01-01 11:30:00' b")
    got = row.select(*[c.alias(k) for k, c in time.time_features(F.col("a"), F.col("b")).items()]).first()
    assert tuple(got) == (10, 0, 1, 1.5)


def parsed_text(t):
    """What the standard library's parser makes of a fragment."""
    from html.parser import HTMLParser

    class Text(HTMLParser):
        parts, hidden = (), 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style") and self.hidden > 0

        def handle_data(self, data):
            self.parts = (*self.parts, data) if not self.hidden else self.parts

    p = Text()
    p.feed(t or "")
    p.close()
    return " ".join(" ".join(p.parts).split())


def test_html_as_parsed(spark):
    given = [
        "&lt;b&gt; &#65;&#x42; &eacute;&euro; &notanentity; &copy 2 &amp;lt; &#128; &#0; a&b a & b &ltx", '<a title="x > y">t</a>', "1 < 2 and 3 > 2", "<br/>a<br>b", "<style>p{}</style>x<script>a<b</script>y",
        "<!-- <b> -->z", "<p>unclosed", "&#55296; &#1114112;", "<!DOCTYPE html><p>x</p>", None, "",
    ]
    assert values(spark, text.clean_html, given) == [parsed_text(t) for t in given]
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html")
    got = pages.select("html", text.clean_html(F.col("html")).alias("t")).collect()
    assert all(r.t == parsed_text(r.html) for r in got) and len(got) > 20


def test_html(spark):
    given = [None, "<p>a&amp;b</p>", "d&nbsp;&nbsp;e", "<b>x</b><i>y</i>", "<script>no</script>z<!-- c -->"]
    assert values(spark, text.clean_html, given) == ["", "a&b", "d e", "x y", "z"]
    assert values(spark, text.clean_markup, given) == ["", "a&b", "d e", "x y", "z"]


def test_entities_that_must_end(spark):
    """As the SQL of clean_html: an entity that was cut off stays as it is."""
    given = ["<p>a&&amp</p><b>b</b>", "&lt;c&gt &copy;", "&amp;lt; &#39;"]
    assert values(spark, lambda c: text.clean_html(c, bare=False), given) == ["a&&amp b", "<c&gt ©", "&lt; '"]


def test_privacy(spark):
    assert values(spark, lambda c: privacy.surrogate(c, "PER", "s"), ["x", " X ", None]) == ["PER_ebaa37", "PER_ebaa37", None]
    got = values(spark, lambda c: privacy.scrub_text(c, "s"), ["call +966 50 123 4567", "12345", "plain", "a@b.co and c@d.co", None])
    assert got[:3] == ["call [PHONE]", "12345", "plain"] and got[3].count("EML_") == 2 and "@" not in got[3] and got[4] is None
    frame = spark.createDataFrame([("A", "a@b.co", "1", "t")], "requester_name string, requester_email string, requester_phone string, lang string")
    out = privacy.anonymize(frame, "s")
    assert out.columns == ["requester_name", "requester_email", "lang"] and out.first().requester_name.startswith("PER_")


def test_texts(spark):
    frame = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in frame.select(text.build_text(F.col("a"), F.col("b"))).collect()] == ["a b", "b", "a", ""]
    assert [r[0] for r in frame.select(text.subject_and_body(F.col("a"), F.col("b"))).collect()][-1] == "."
    assert values(spark, text.strip_signature, ["Fix it. Regards, A", "ok Regards", "Fix it. Best Regards, A", "Fix it. Best Regards"]) == ["Fix it.", "ok Regards", "Fix it. Best", "Fix it."]
    assert values(spark, lambda c: text.strip_signature(c, longest_first=True), ["Fix it. Best Regards, A"]) == ["Fix it."]
    assert values(spark, text.tokens, ["the VPN is down"]) == [["vpn", "down"]]


@pytest.mark.parametrize("line", ["", "a", "Ab cde  fghij", "éà ü"])
def test_char_ngrams(spark, line):
    want = []
    for w in line.lower().split():
        w = f" {w} "
        for n in range(2, 6):
            if n > len(w):
                break
            want += [w[i : i + n] for i in range(len(w) - n + 1)]
    assert sorted(values(spark, text.char_ngrams, [line])[0]) == sorted(want)


def test_counts_and_filters(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in analytics.value_counts(rows, "x", 2).collect()] == [("a", 2), ("b", 1)]
    t = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-02-01 00:00:00'), (TIMESTAMP_NTZ '2024-02-01 00:00:01'), (NULL) AS t(ts)")
    assert analytics.filter_rows(t, {}, "ts", None, "2024-01-31").count() == 1
    k = spark.createDataFrame([("Closed", True), ("Resolved", False), ("Open", None), (None, False)], "status string, late boolean")
    assert tuple(analytics.kpis(k, "status", F.col("late"), "status").first()) == (4, 2, 50.0, 25.0, 3, None)
    assert analytics.kpis(k.where("false"), "status", F.col("late"), "status").first().closed_pct == 0
    assert analytics.null_shares(spark.createDataFrame([(None,), (None,), ("a",)], "c string"), ["c", "no"]).collect() == [("c", 66.7, True)]
    kept, out = analytics.split_predicted(spark.createDataFrame([("system",), ("predicted",), (None,)], "s string"), "s")
    assert kept.count() == 2 and out.first().excluded == 1
    assert analytics.histogram(spark.createDataFrame([(0,), (1,), (30,)], "x int"), "x").agg(F.sum("n")).first()[0] == 3


def test_series(spark):
    ts = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 05:00:00'), (TIMESTAMP_NTZ '2024-01-04 06:00:00'), (NULL) AS t(ts)")
    assert [r.n for r in series.volume(ts, "ts").orderBy("bucket").collect()] == [1, 0, 0, 1]
    assert series.volume(ts.where("ts is null"), "ts").count() == 0 and series.daily_volume(ts.where("false"), "ts").count() == 0
    for given, want in (([1, 2, 3, 4, 5, 6, 7], [1, 2, 3, 4, 5, 6, 7, 1, 2]), ([1, 2, 3], [3, 3, 3, 3, 1, 2, 3])):
        train = spark.createDataFrame([("g", dt.date(2024, 1, 1 + i), y) for i, y in enumerate(given)], "g string, ds date, y int")
        assert [r.yhat for r in series.naive_forecast(train, len(want), ["g"]).orderBy("step").collect()] == want
    pairs = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "a double, p double")
    assert pairs.agg(F.avg(time.ape(F.col("a"), F.col("p")))).first()[0] == 0.75
    v = series.verdict(spark.createDataFrame([(0.5, 0.4), (0.5, 0.48), (0.0, 0.1)], "naive_mape double, model_mape double"))
    assert [r.winner for r in v.collect()] == ["model", "naive", "naive"] and series.overall(v).first().recommended is False
    for months, want in (([1, 1], "insufficient history"), ([5, 1, 1], "stable"), ([10, 10, 20, 20, 20], "rising"), ([20, 20, 10, 10, 10], "falling"), ([10] * 5, "stable")):
        rows = spark.createDataFrame([("g", dt.datetime(2024, 1 + m, 2)) for m, n in enumerate(months) for _ in range(n)], "g string, ts timestamp_ntz")
        assert series.monthly_trend(rows, "ts", ["g"]).first().trend == want


def test_bends_are_few_and_found():
    import numpy as np

    t = np.arange(200.0)
    x, at = np.stack([np.ones(200), t / 200], 1), np.linspace(0, 170, 21)[1:]
    y = 5 + 0.05 * t + 0.4 * np.maximum(t - at[9], 0) + np.random.default_rng(0).normal(0, 0.3, 200)
    hinges = np.maximum(t[:, None] - at, 0) / 200
    beta, bends = series.fit_bends(x, hinges, y, sparse=0.05)
    assert np.abs(bends).argmax() in (8, 9, 10) and (np.abs(bends) > 1e-9).sum() <= 8 and np.abs(x @ beta + hinges @ bends - y).mean() < 0.6
    # no bend is worth it where the penalty is that of all being 0
    assert not series.fit_bends(x, hinges, y, sparse=1.0)[1].any()


def test_forecast_follows_bends_and_covers(spark):
    import numpy as np

    r, rows, truth = np.random.default_rng(5), [], {}
    for g in range(12):
        days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(228)]
        level = [60 + 0.1 * i + (0.5 if g % 2 else -0.2) * max(i - 120, 0) + 8 * (d.weekday() < 5) for i, d in enumerate(days)]
        values = [max(0.0, v + r.normal(0, 4)) for v in level]
        rows += [(f"g{g}", d, v) for d, v in zip(days[:200], values)]
        truth |= {(f"g{g}", d): v for d, v in zip(days[200:], values[200:])}
    got = series.seasonal_forecast(spark.createDataFrame(rows, "k string, ds date, y double"), "k").collect()
    assert {(x.group, x.ds) for x in got} == {*truth}
    inside = np.mean([x.yhat_lower <= truth[x.group, x.ds] <= x.yhat_upper for x in got])
    assert 0.65 <= inside <= 0.97 and all(x.yhat_lower <= x.yhat_upper for x in got)
    assert np.mean([abs(x.yhat - truth[x.group, x.ds]) / truth[x.group, x.ds] for x in got]) < 0.1


def test_series_of_all_and_the_largest(spark):
    rows = [("a", 1)] * 3 + [("b", 1), ("b", 4), ("c", 2), ("c", 2), ("d", 9), (None, 3)]
    df = spark.createDataFrame([(g, dt.datetime(2024, 1, d)) for g, d in rows] + [("a", None)], "team string, t timestamp")
    got = {(x.group, x.ds.day): x.y for x in series.daily_with_all(df, "t", "team", 3).collect()}
    assert got == {**{("ALL", d): {1: 4, 2: 2, 3: 1, 4: 1, 9: 1}.get(d, 0) for d in range(1, 10)}, ("a", 1): 3, ("b", 1): 1, ("b", 2): 0, ("b", 3): 0, ("b", 4): 1, ("c", 2): 2}
    assert {x.group for x in series.forecast_teams(df, "t", "team", 5).collect()} == {"ALL", "a", "b", "c"}
    assert series.forecast_teams(df.where("false"), "t", "team").count() == 0


def test_evaluation(spark):
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, i) if i < 10 else None) for i in range(1, 11)], "k int, ts timestamp_ntz")
    split = evaluation.temporal_split(rows, "ts", "k")
    assert [r.k for r in split.where("is_test").orderBy("k").collect()] == [9, 10] and split.count() == 10
    labels = spark.createDataFrame([(x,) for x, n in zip("abcde", (5, 4, 3, 2, 1)) for _ in range(n)], "l string")
    assert evaluation.fold_top(labels, "l").where("l = 'Other'").count() == 3
    rare = spark.createDataFrame([("a",)] * 10 + [("b",)] * 9, "l string")
    assert evaluation.fold_rare(rare, "l").where("l = '__other__'").count() == 9
    evaluation.assert_no_leakage(["subject"])
    with pytest.raises(ValueError, match="status"):
        evaluation.assert_no_leakage(["subject", "status"])
    with pytest.raises(ValueError, match="group"):
        evaluation.assert_no_leakage(["group"], allowed_only=True)
    g = spark.createDataFrame([(0.45,), (0.449,)], "c double").select(evaluation.gate(F.col("c"), F.lit("T")).alias("g")).select("g.*")
    assert [tuple(r) for r in g.collect()] == [("T", None), ("needs manual routing", "T")]
    both = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string")
    assert evaluation.confusion(both, "t", "p", ["a", "b", "c"]).groupBy().sum("a", "b", "c").first() == (1, 2, 0)


def test_temporal_split_with_other_columns(spark):
    rows = spark.range(40_000).selectExpr("(id * 7919) % 40000 as k", "if(id % 11 = 0, null, timestamp_millis(cast((id * 31) % 997 as bigint) * 86400000)) as ts", "repeat(cast(id as string), 5) as payload", "id % 3 as other").repartition(8)
    got = evaluation.temporal_split(rows, "ts", "k", parts=8)
    assert got.columns == ["k", "ts", "payload", "other", "is_test"]
    pairs = [(r.k, r.is_test) for r in got.select("k", "ts", "is_test", "payload").orderBy(F.col("ts").asc_nulls_last(), "k").collect()]
    assert [t for _, t in pairs] == [i >= 32_000 for i in range(40_000)]
    assert evaluation.temporal_split(rows.where("false"), "ts", "k").count() == 0
    # rows that are repeated in full stay together
    same = spark.createDataFrame([(1, None, "x")] * 7 + [(0, None, "x")], "k int, ts timestamp_ntz, p string")
    assert {r.is_test for r in evaluation.temporal_split(same, "ts", "k").where("k = 1").collect()} in ({True}, {False})


def test_stratified_split_and_folds(spark):
    rows = spark.range(10_000).selectExpr("id as k", "case when id % 100 = 0 then 'c' when id % 3 = 0 then null else 'a' end as l", "'p' as payload")
    got = evaluation.stratified_split(rows, "l", "k", 0.25).groupBy("l").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert all(r.t == r.n // 4 for r in got) and len(got) == 3
    many = spark.range(3000).selectExpr("cast(if(id < 1000, 0, id % 500) as string) as l", "id")
    want = {r.l: r.n for r in many.groupBy("l").agg(F.count("*").alias("n")).where("n >= 5").collect()}
    for most in (evaluation.BROADCAST_ROWS, 8):
        old, evaluation.BROADCAST_ROWS = evaluation.BROADCAST_ROWS, most
        try:
            folded = {r.l: r.n for r in evaluation.fold_rare(many, "l", 5).groupBy("l").agg(F.count("*").alias("n")).collect()}
        finally:
            evaluation.BROADCAST_ROWS = old
        assert {k: v for k, v in folded.items() if k != "__other__"} == want and sum(folded.values()) == 3000
    first = analytics.first_per_key(spark.createDataFrame([(1, 2, "b"), (1, None, "n"), (None, 1, "x"), (None, 0, "y")], "k int, o int, v string"), ["k"], ["o"])
    assert {(r.k, r.v) for r in first.collect()} == {(1, "n"), (None, "y")}


def test_index_and_thresholds(spark, tmp_path):
    docs = spark.createDataFrame([(1, "printer jam on floor two", "replaced the roller and cleaned it"), (2, "printer jam again", "replaced the roller and cleaned it"), (3, "vpn down", "restarted the gateway service now"), (4, "vpn down at home", "done")], "id int, t string, r string").withColumn("s", F.lit("Closed"))
    usable = retrieval.resolved(docs, "s", "r")
    assert usable.count() == 3 and retrieval.resolved(docs.withColumn("s", F.lit("Open")), "s", "r").count() == 0
    grams = text.char_ngrams(F.col("t"))
    retrieval.build_index(docs, "id", grams, str(tmp_path / "ix"), ["r"])
    found = retrieval.query_index(spark.createDataFrame([(9, "printer jam")], "id int, t string"), "id", grams, str(tmp_path / "ix"), 2).orderBy("rank").collect()
    assert {r.doc_id for r in found} == {1, 2} and found[0].r.startswith("replaced")
    w = retrieval.weights(retrieval.term_counts(usable, "id", grams), "id", min_df=1)
    hits = retrieval.similar(w, w, "id", 1)
    answers = retrieval.weights(retrieval.term_counts(usable, "id", text.word_ngrams(F.col("r"))), "id", min_df=1)
    got = {r.threshold: (r.n_queries, r.hits_at_1) for r in retrieval.recall_at_thresholds(hits, answers, "id", 1).collect()}
    assert set(got) == {0.5, 0.6, 0.8} and got[0.8][1] == 2


def test_retrieval_leaves_itself_out(spark):
    docs = spark.createDataFrame([(1, "red car"), (2, "red car fast"), (3, "blue sky"), (4, "blue car")], "id int, t string")
    w = retrieval.weights(retrieval.term_counts(docs, "id", text.word_ngrams(F.col("t"))), "id")
    got = retrieval.similar(w, w, "id", 1).collect()
    assert all(r.query_id != r.doc_id for r in got) and {(r.query_id, r.doc_id) for r in got} >= {(1, 2), (2, 1)}


def test_search_by_products(spark, monkeypatch):
    """In blocks and batches of any size the search gives what all pairs give, equal ones by key."""
    words = "red blue car sky fast slow old new".split()
    docs = spark.createDataFrame([(i, " ".join(words[(i * j + i // 7) % 8] for j in range(1, 2 + i % 5)) if i % 11 else "") for i in range(120)] + [(None, "red car")], "id long, t string")
    grams = text.word_ngrams(F.col("t"))
    w = retrieval.weights(retrieval.term_counts(docs, "id", grams), "id").where("id is not null")
    pairs = w.where("id % 3 = 0").select(F.col("id").alias("query_id"), "gram", F.col("w").alias("qw")).join(w.withColumnRenamed("id", "doc_id"), "gram").where("query_id <> doc_id")
    want = sorted(tuple(r) for r in retrieval.top_k(pairs.groupBy("query_id", "doc_id").agg(F.round(F.sum(F.col("qw") * F.col("w")), 9).alias("similarity")), 4).select("query_id", "rank", "doc_id").collect())
    for numbers, held in ((4_000_000, 2_000_000), (40, 50)):
        monkeypatch.setattr(retrieval, "BLOCK_NUMBERS", numbers)
        monkeypatch.setattr(retrieval, "HELD", held)
        v = retrieval.kept_vectors(docs, "id", grams, F.expr("id % 3 = 0"))
        hits = retrieval.similar_vectors(v.where("id % 3 = 0"), v, "id", 4)
        assert sorted(tuple(r) for r in hits.select("query_id", "rank", "doc_id").collect()) == want and len(want) > 100
        rows = spark.createDataFrame([(i, [float(i % 4), float(i % 3 - 1)]) for i in range(30)] + [(3, [9.0, 9.0])], "id int, v array<float>")
        got = retrieval.nearest(rows.where("id % 3 = 0"), rows, "id", "v", 3).collect()
        plain = [(r.id, r.v) for r in rows.collect()]
        for q in {i for i, _ in plain if i % 3 == 0}:
            best = sorted((-sum(a * b for a, b in zip(x, y)), d) for i, x in plain if i == q for d, y in plain if d != q)[:3]
            assert sorted((-r.similarity, r.doc_id) for r in got if r.query_id == q) == best



@pytest.mark.parametrize("name", ["char_ngrams", "word_ngrams"])
def test_grams_do_not_move(spark, name):
    """Texts are dealt before their grams are made; nothing is shuffled after."""
    from tidemark.plans import registry

    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")  # the plan is printed from its end



def test_vectors(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert rows.select(vector.dot(F.col("a"), F.col("b")), vector.normalize(F.col("a")), vector.mean_of(F.col("a"), F.col("b"))).first() == (3.0, [0.6, 0.8], [2.0, 2.0])
    same = values(spark, vector.hashed_embedding, ["Printer jam", "printer jam", None])
    assert same[0] == same[1] and not any(same[2])


def test_imputation_marks_provenance(spark):
    rows = [(i, "vpn network down" if i % 2 else "printer paper jam", None if i % 10 == 0 else ("net" if i % 2 else "print")) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, subject string, grp string")
    target = models.Target("requests", "grp", ("subject", "absent"))
    out = models.impute(df, target, models.train_imputer(df, target, features=256)).collect()
    assert all((r.grp_source == "system") == (r.id % 10 != 0) for r in out) and all(r.grp == "print" for r in out if r.id % 10 == 0)
    assert models.train_imputer(df.limit(50), target) is None


def test_rows_do_not_move_to_their_class(spark):
    """The weights of classes are broadcast, also where Spark knows no sizes."""
    rows = spark.range(1000).selectExpr("if(id % 4 = 0, 'a', 'b') as l", "id")
    out = models.balanced(rows, "l")
    assert {(r.l, round(r.w, 6)) for r in out.select("l", F.col("__weight").alias("w")).collect()} == {("a", 2.0), ("b", 0.666667)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = models.balanced(rows, "l")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan



def test_generic_flattening(spark):
    record = {"t": {"value": "1700000000123", "display_value": "x"}, "s": {"name": "A", "id": "1"}, "n": {"name": None, "id": "1"}, "o": {"id": "1"}, "l": [1, 2], "x": 5, "z": None}
    rows = spark.createDataFrame([(json.dumps(record),)], "j string").select(F.parse_json("j").alias("record"))
    got = tables.flatten_generic(rows).first().asDict()
    odd = spark.createDataFrame([('{"it\'s": 1, "a\\"b": "x", "c.d": [1]}',)], "j string").select(F.parse_json("j").alias("record"))
    assert tables.flatten_generic(odd).first().asDict() == {"it's": "1", 'a"b': "x", "c.d_count": 1}
    assert got == {"l_count": 2, "n": None, "o": "1", "s": "A", "t": dt.datetime(2023, 11, 14, 22, 13, 20, 123000), "x": "5", "z": None}


def test_pages_and_dedup(spark):
    pages = spark.createDataFrame([("page_0002.json", '{"other":[{"id":"1","v":2}]}'), ("page_0001.json", '{"requests":[{"id":"1","v":1},{"id":"2","v":1}]}'), ("page_0003.json", '{"x":1}'), ("page_0004.json", "damaged")], "file string, value string")
    got = files.dedup(files.page_records(pages, "requests")).select("id", nested.pick(F.col("record"), "v").alias("v")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", "1"), ("2", "1")]


class Server(BaseHTTPRequestHandler):
    failures = {"left": 0}
    cap, total, more = 100, True, True
    bad, asked, stop, hold = {}, [], None, None
    rows = [{"id": str(i), "subject": f"s{i}"} for i in range(1, 26)]

    def do_GET(self):
        if self.failures["left"]:
            self.failures["left"] -= 1
            return self.say(503, {})
        url = urlparse(self.path)
        if "input_data" in (q := parse_qs(url.query)):
            info = json.loads(q["input_data"][0])["list_info"]
            a, n = info["start_index"], info["row_count"]
            part = self.rows[a - 1 : a - 1 + min(n, self.cap)]
            said = {"start_index": a} | ({"total_count": len(self.rows)} if self.total else {}) | ({"has_more_rows": a - 1 + len(part) < len(self.rows)} if self.more else {})
            return self.say(200, {"requests": part, "list_info": said})
        id = url.path.rsplit("/", 1)[-1]
        if not url.path.endswith("notes"):
            self.asked.append(id)
        if self.hold and len(self.asked) > self.hold:
            self.stop.wait(20)
        if id in self.bad:  # a body that is no JSON, or one that is cut short
            self.send_response(200)
            self.send_header("Content-Length", "99")
            self.end_headers()
            self.wfile.write(b"x" * 99 if self.bad[id] == "text" else b"{")
            return
        return self.say(404 if url.path.endswith("notes") else 200, {"request": {"id": url.path.rsplit("/", 1)[-1]}})

    def say(self, status, value):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(value).encode())

    def log_message(self, *_):
        pass


@pytest.fixture()
def server(monkeypatch):
    monkeypatch.setattr(Server, "bad", {})
    monkeypatch.setattr(Server, "asked", [])
    monkeypatch.setattr(Server, "stop", threading.Event())
    s = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_rest_source(spark, server, tmp_path):
    waits = []
    client = rest.Client(rest.Settings(server, page_size=10), waits.append)
    Server.failures["left"] = 2
    assert [len(p["requests"]) for p in client.pages("requests")] == [10, 10, 5] and waits == [2.0, 4.0]
    assert [len(p["requests"]) for p in client.pages("requests", 12)] == [10, 2]
    assert "_error" in client.bundle("requests", "7")["notes"]
    Server.failures["left"] = 99
    with pytest.raises(rest.RequestFailed):
        client.page("requests", 1, 1)
    Server.failures["left"] = 0
    rest.register(spark)
    read = spark.read.format("tickets").option("url", server).option("page_size", 10).option("pages_per_task", 1)
    assert read.load().count() == 25 and read.option("limit", 12).load().select("id").distinct().count() == 12
    raw = str(tmp_path)
    assert files.land_pages(spark, client.pages("requests"), raw, "requests") == [str(i) for i in range(1, 26)] and files.modules_in(spark, raw) == ["requests"]

    def broken():
        yield {"requests": [{"id": "new"}]}
        raise OSError("gone")

    with pytest.raises(OSError):
        files.land_pages(spark, broken(), raw, "requests")
    assert files.page_records(files.read_pages(spark, f"{raw}/requests"), "requests").count() == 25 and files.modules_in(spark, raw) == ["requests"]
    rows, module = files.sample(spark, f"{raw}/requests/page_0001.json:requests")
    assert rows.count() == 10 and module == "requests"


@pytest.mark.parametrize("cap, total, more", [(10, True, True), (100, False, True), (7, False, True), (7, True, False), (3, True, True)])
def test_rest_source_is_complete(spark, server, monkeypatch, cap, total, more):
    """Servers that cap pages, tell no total, or (more: False) leave out whether there is more."""
    monkeypatch.setattr(Server, "cap", cap)
    monkeypatch.setattr(Server, "total", total)
    monkeypatch.setattr(Server, "more", more)
    rest.register(spark)
    read = spark.read.format("tickets").option("url", server).option("page_size", 10).option("pages_per_task", 1)
    got = read.load()
    ids = [str(i) for i in range(1, 26)]
    assert sorted((r.id for r in got.collect()), key=int) == ids
    assert [r.id for r in got.orderBy("page", "position").collect()] == ids
    assert sorted((r.id for r in read.option("limit", 12).load().collect()), key=int) == ids[:12]


def test_rest_helpers():
    assert rest.parse_modules("requests, sites") == ["requests", "sites"] and len(rest.parse_modules("all")) == 10
    with pytest.raises(ValueError, match="nope"):
        rest.parse_modules("nope")
    assert rest.backoff(1) == 2 and rest.backoff(9) == 30 and rest.backoff(1, "7") == 7 and rest.backoff(1, "soon") == 2 == rest.backoff(1, "0") == rest.backoff(1, "-3")
    assert [rest.throttle_wait(n) for n in (1, 2, 5, 9)] == [30, 60, 300, 300]
    assert rest.is_throttle(400, '{"response_status": {"status_code": 4001}}') and not rest.is_throttle(400, "x")
    assert rest.Settings.from_env({"TICKETS_URL": "http://x/api/v3/", "TICKETS_PAGE_SIZE": "500"}) == rest.Settings("http://x", page_size=100)
    assert rest.base_url("https://x/API/V3/") == "https://x"
    assert rest.dotenv("# c\nexport A=1\nB = 'x # y'\nC=2 # z\n") == {"A": "1", "B": "x # y", "C": "2"}
    with pytest.raises(ValueError, match="key"):
        rest.Settings("http://x").connected()
    assert rest.Settings.from_env({"TICKETS_URL": "http://x", "TICKETS_VERIFY": "off"}).verify is False
    assert rest.records({"a": 1, "b": [{"id": 1}]}, "requests") == [{"id": 1}] and rest.records({"a": [1]}, "requests") == []


def ids_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_details_land_as_they_are_fetched(spark, server, tmp_path):
    """Bodies that are no JSON or cut short are those records' errors; all others land, once."""
    folder, settings = str(tmp_path / "details"), rest.Settings(server, max_retries=0)
    Server.bad.update({"3": "text", "4": "cut"})
    got, skipped = landing.land_details(ids_of(spark, *map(str, range(1, 13)), "2", None), settings, "requests", folder, per_file=2, per_task=5)
    assert (got.details, got.errors, skipped) == (10, 2, 0)
    assert {r.id for r in landing.landed_details(spark, folder).collect()} == {str(i) for i in range(1, 13)} - {"3", "4"}
    assert {(r.id, r.error[:13]) for r in landing.failed_details(spark, folder).collect()} == {("3", "RequestFailed"), ("4", "RequestFailed")}
    Server.bad.clear()
    Server.asked.clear()
    got, skipped = landing.land_details(ids_of(spark, *map(str, range(1, 13))), settings, "requests", folder)
    assert (got.details, got.errors, skipped) == (2, 0, 10) and sorted(Server.asked) == ["3", "4"]
    got, skipped = landing.land_details(ids_of(spark, "1"), settings, "requests", folder)
    assert (got, skipped) == (landing.Landed(), 1) and landing.landed_details(spark, folder).count() == 12
    assert not [f for f in os.listdir(folder) if f.startswith(".") and not f.endswith(".crc")]


def test_a_killed_run_fetches_only_what_is_missing(spark, server, tmp_path, monkeypatch):
    folder, settings, want = str(tmp_path / "details"), rest.Settings(server, max_retries=0), [f"{i:02d}" for i in range(20)]
    ids = ids_of(spark, *want).coalesce(1).sortWithinPartitions("id")
    monkeypatch.setattr(Server, "hold", 13)

    def kill():
        for _ in range(600):
            if len(Server.asked) > Server.hold:
                break
            clock.sleep(0.05)
        spark.sparkContext.cancelAllJobs()

    killer = threading.Thread(target=kill)
    killer.start()
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of it
        landing.land_details(ids, settings, "requests", folder, notes=False, per_file=3, per_task=100)
    killer.join()
    clock.sleep(4)  # the killed task's worker ends
    Server.stop.set()
    landed = {r.id for r in landing.landed_details(spark, folder).collect()}
    assert 0 < len(landed) < 20 and len(landed) % 3 == 0
    monkeypatch.setattr(Server, "hold", None)
    Server.asked.clear()
    got, skipped = landing.land_details(ids, settings, "requests", folder, notes=False)
    assert skipped == len(landed) and got.details == 20 - len(landed) and set(Server.asked) == set(want) - landed
    assert {r.id for r in landing.landed_details(spark, folder).collect()} == set(want)


def test_pages_land_by_tasks(spark, server, tmp_path, monkeypatch):
    raw, settings = str(tmp_path), rest.Settings(server, page_size=4)
    for cap, pages in ((100, 7), (3, 10)):
        monkeypatch.setattr(Server, "cap", cap)
        got = landing.land_module(spark, settings, "requests", raw, pages_per_task=2)
        assert (got.records, got.pages) == (25, pages)
        rows = files.dedup(files.page_records(files.read_pages(spark, f"{raw}/requests/page_*.json"), "requests"))
        assert sorted((r.id for r in rows.select("id").collect()), key=int) == [str(i) for i in range(1, 26)]
    assert landing.land_module(spark, settings, "requests", raw, limit=6).records == 6
    Server.failures["left"] = 99
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of it
        landing.land_module(spark, rest.Settings(server, max_retries=0), "requests", raw)
    Server.failures["left"] = 0
    assert files.read_pages(spark, f"{raw}/requests/page_*.json").count() and files.modules_in(spark, raw) == ["requests"]


def test_news_are_read_once(spark, server, tmp_path, monkeypatch):
    out, seen = str(tmp_path / "out"), []
    for n, restart in ((10, False), (10, False), (17, True), (17, False), (25, False)):
        monkeypatch.setattr(Server, "rows", [{"id": str(i)} for i in range(1, n + 1)])
        ingest.follow(spark, {"url": server, "page_size": "4"}, out, str(tmp_path / "cp")).awaitTermination()
        got = sorted((r.id for r in spark.read.parquet(out).collect()), key=int)
        seen.append(len(got))
        assert got == [str(i) for i in range(1, n + 1)]
        if restart:  # the commit of the last batch is lost: it is made again, from the offsets that were kept
            commits = tmp_path / "cp" / "commits"
            last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
            os.unlink(commits / last)
            os.unlink(commits / f".{last}.crc")
    assert seen == [10, 10, 17, 17, 25]


def test_latest_versions(spark, tmp_path):
    """Late and repeated rows of an id give one row, and later batches what is newer only; what is old is forgotten."""
    (tmp_path / "in").mkdir()
    days = [[("a", 1, 1), ("b", 5, 1), ("a", 3, 2), ("a", 2, 1)], [("b", 5, 2), ("b", 4, 2), ("a", 7, 3), (None, 1, 3), ("d", None, 3)], [("c", 1, 3), ("c", 1, 3)], [("e", 1, 25)], [("e", 2, 26)]]
    for n, rows in enumerate(days):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps({"id": i, "version": v, "payload": f"{i}{v}", "at": f"2024-01-{d:02d}T00:00:00"}) for i, v, d in rows))
        os.utime(tmp_path / "in" / f"{n}.json", (1e9 + n, 1e9 + n))
    stream = spark.readStream.schema("id string, version long, payload string, at timestamp").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    latest = ingest.latest_versions(stream, "id", "version", "payload", "at", "10 days")
    run = latest.writeStream.outputMode("update").format("memory").queryName("latest_versions").trigger(availableNow=True).start()
    try:
        assert run.awaitTermination(60)
    finally:
        run.stop()
    assert sorted(map(tuple, spark.table("latest_versions").collect())) == [("a", 3, "a3"), ("a", 7, "a7"), ("b", 5, "b5"), ("c", 1, "c1"), ("e", 1, "e1"), ("e", 2, "e2")]
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress]
    assert max(rows) >= 3 and rows[-1] == 1


def test_stream_refresh(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for n in (1, 2):
        (landing / f"page_{n}.json").write_text(json.dumps({"requests": [{"id": str(n)}]}))
        ingest.refresh(spark, str(landing), "requests", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n


def test_jobs(tmp_path, spark):
    store = Store(spark, str(tmp_path))
    assert jobs.refresh([("a", lambda: None)], store)["state"] == "done"
    with pytest.raises(ZeroDivisionError):
        jobs.refresh([("b", lambda: 1 / 0)], store)
    assert store.read_json("status.json")["error"].startswith("b:") and files.read_json(tmp_path / "none") is None
    assert jobs.run_modules(["x", "y"], lambda m: 1 / (m != "x")) == {"x": "division by zero", "y": None}
    models.save_metrics(spark, [{"module": "m", "column": "c", "f1": 1}], str(tmp_path))
    models.save_metrics(spark, [{"module": "m", "column": "c", "f1": 2}], str(tmp_path))
    assert json.loads((tmp_path / "metrics.json").read_text()) == [{"module": "m", "column": "c", "f1": 2}]
    assert "| a |" in jobs.markdown(spark.createDataFrame([("x", 1)], "a string, n int").select("a"), "T")


def test_lease(spark, tmp_path):
    store, at = Store(spark, str(tmp_path)), [1000.0]
    lease = lambda: jobs.Lease(store, "lock", 60, lambda: at[0])
    first, second = lease(), lease()
    assert first.acquire() == 1
    with pytest.raises(RuntimeError, match="running"):
        second.acquire()
    at[0] += 50
    first.renew()
    at[0] += 50  # renewed: it lasts on
    with pytest.raises(RuntimeError, match="running"):
        second.acquire()
    at[0] += 61  # stale: taken over, and the first can write no more
    assert second.acquire() == 2
    for act in (first.check, first.renew):
        with pytest.raises(jobs.Superseded):
            act()
    first.release()  # which does not end the second's
    with pytest.raises(RuntimeError, match="running"):
        lease().acquire()
    second.release()
    # a crash between making and writing leaves an empty document: over once it is as old as a lease
    (tmp_path / "lock" / f"{3:012d}").write_text("")
    at[0] = (tmp_path / "lock" / f"{3:012d}").stat().st_mtime + 30
    with pytest.raises(RuntimeError, match="running"):
        lease().acquire()
    at[0] += 31
    # contested: both see the same last number, one gets the next
    won, lost = [], []

    def contest():
        try:
            won.append(lease().acquire())
        except RuntimeError as e:
            lost.append(e)

    both = [threading.Thread(target=contest) for _ in range(6)]
    [t.start() for t in both]
    [t.join() for t in both]
    assert won == [4] and len(lost) == 5
    with pytest.raises(jobs.Superseded):  # a step during which the lease goes to another run
        jobs.refresh([("a", lambda: store.create("other/000000000002", "{}")), ("b", lambda: None)], store, "s.json", "other")
    assert store.read_json("s.json")["step"] == "a"


def test_command_lines(spark, server, tmp_path, monkeypatch):
    from tidemark import cli

    data = str(tmp_path)
    monkeypatch.setenv("TICKETS_URL", server)
    monkeypatch.setenv("TICKETS_KEY", "k")
    monkeypatch.setattr(Server, "rows", [{"id": str(i), "subject": f"mail a{i}@b.co", "requester": {"name": f"P {i}"}, "status": {"name": "Open"}} for i in range(1, 26)])
    run = lambda *a: cli.main(["--data", data, *a], spark)
    assert run("extract", "--modules", "requests", "--limit", "12") == 0
    assert run("extract", "--modules", "requests") == 0
    assert spark.read.parquet(f"{data}/raw/details/requests").count() == 25
    assert run("preprocess", "--anonymize", "--csv") == 0
    plain, anon = files.read_processed(spark, f"{data}/processed", "requests"), files.read_processed(spark, f"{data}/processed", "requests_anon")
    assert plain.count() == 25 == anon.count() and anon.where("requester_name like 'PER_%' and subject like 'mail EML_%'").count() == 25
    first = (tmp_path / "processed/requests.csv").read_bytes()
    assert first.startswith(b"\xef\xbb\xbfid,") and first.count(b"\n") == 26
    salt, kept = privacy.stored_salt(spark, f"{data}/processed/anon_map"), privacy.load_map(spark, f"{data}/processed/anon_map").count()
    assert run("preprocess", "--modules", "requests", "--anonymize") == 0
    assert privacy.stored_salt(spark, f"{data}/processed/anon_map") == salt and privacy.load_map(spark, f"{data}/processed/anon_map").count() == kept == 25
    assert run("train") == 0 and run("predict") == 0 and run("explore") == 0
    assert "Most frequent values" in (tmp_path / "reports/requests.md").read_text()
    assert run("cluster", "--module", "nothing") == 1 and run("forecast") == 0  # these rows have no times: an empty forecast
    with pytest.raises(SystemExit):
        run("nothing")


def test_cluster_and_forecast_jobs(spark, tmp_path):
    texts = ["vpn does not connect from home office network", "printer paper jam in tray two of floor three", "password reset for locked account please"]
    rows = [(str(i), f"{texts[i % 3]} {'abcdefgh'[i % 8]}", None, f"team {i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=23 * i)) for i in range(150)]
    df = spark.createDataFrame(rows, "id string, subject string, description string, `group` string, created_time timestamp")
    processed, reports = str(tmp_path / "processed"), tmp_path / "reports"
    files.write_processed(df, processed, "requests")
    found = jobs.cluster(spark, processed, str(reports), min_size=15)
    best = {k: found.where(F.col("group") == f"team {k}").groupBy("cluster").count().orderBy(F.desc("count")).first() for k in range(3)}
    assert len({b.cluster for b in best.values()}) == 3 and all(b["count"] >= 45 and b.cluster >= 0 for b in best.values())
    assert "Largest clusters" in (reports / "requests_clusters.md").read_text() and "connect" in (reports / "requests_clusters.md").read_text()
    made = jobs.forecast(spark, processed, str(reports))
    assert made.groupBy("group").count().count() == 4 and made.count() == 4 * 28
    assert "Model against naive" in (reports / "requests_forecast.md").read_text()


def test_processed_tables_fall_back(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, 'a "q", b\nc', None), (2, "é", 1.5)], "id int, t string, x double")
    assert files.read_processed(spark, str(tmp_path), "t") is None
    files.export_csv(df, str(tmp_path), "t.csv")
    got = files.read_processed(spark, str(tmp_path), "t")
    assert got.columns == ["id", "t", "x"] and {r.t for r in got.collect()} == {'a "q", b\nc', "é"}
    files.write_processed(df, str(tmp_path), "t")
    files.write_processed(df.limit(1), str(tmp_path), "t_enriched")
    assert files.read_processed(spark, str(tmp_path), "t").count() == 1 and files.read_processed(spark, str(tmp_path), "t", enriched=False).count() == 2
    monkeypatch.setattr(type(df.write), "parquet", lambda *_: 1 / 0)
    assert "zero" in files.write_processed(df, str(tmp_path), "broken", as_csv=True) and (tmp_path / "broken.csv").exists()


def test_saved_models(spark, tmp_path):
    rows = [(i, "vpn network down" if i % 2 else "printer paper jam", None if i % 10 == 0 else ("net" if i % 2 else "print")) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, subject string, grp string")
    target = models.Target("requests", "grp", ("subject",))
    folder = str(tmp_path / "models")
    assert models.load_imputer(spark, target, folder) is None and models.enrich_module(df, "requests", folder, [target]) is None
    models.save_imputer(models.train_imputer(df, target, features=256), target, folder)
    rich = models.enrich_module(df, "requests", folder, [target])
    assert rich.where("grp_source = 'predicted'").count() == 20 and rich.where("grp is null").count() == 0
    known = df.where("grp is not null")
    router = models.train_router(known, "grp", F.col("subject"), features=256)
    models.save_router(router, spark, str(tmp_path / "router"))
    again = models.load_router(spark, str(tmp_path / "router"))
    pick = lambda r: [(x.id, x.predicted, round(x.confidence, 9)) for x in models.route(df, r, F.col("subject")).orderBy("id").collect()]
    assert pick(router) == pick(again) and models.load_router(spark, str(tmp_path / "none")) is None
    vectors = embedding.embedded(known, F.col("subject"), str(tmp_path / "cache"))
    model = models.train_embedding_classifier(vectors, "grp", "embedding")
    assert models.classify_embeddings(vectors, model, "embedding").where("predicted = grp").count() == known.count()
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 2
    assert embedding.embedded(df, F.col("subject"), str(tmp_path / "cache")).count() == 200 and spark.read.parquet(str(tmp_path / "cache")).count() == 2


def test_router_reads_its_rows_once(spark):
    """Labels and texts are made once for all fits, and nothing stays cached."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(t):
        seen.add(1)
        return t

    rows = [(i, "vpn network down" if i % 3 else "printer paper jam", ["net", "print", "net", "mail"][i % 4]) for i in range(240)]
    df = spark.createDataFrame(rows, "id int, subject string, grp string").repartition(2).withColumn("subject", told("subject"))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    router = models.train_router(df, "grp", F.col("subject"), features=256)
    assert seen.value == 240 and spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert len(router["names"]) == len(router["machines"]) == len(router["sigmoid"]) == 3


def test_routing_evaluation(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), (f"vpn network down in room {i}" if i % 2 else f"printer paper jam on floor {i}"), "net" if i % 2 else "print") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, subject string, grp string")
    got = models.evaluate_router(df, "grp", "ts", "id", ["subject"], features=512)
    assert got["top"] == ["net", "print"] and tuple(got["acceptance"].first()) == (2, 2, True) and got["routed"].count() == 40
    with pytest.raises(ValueError, match="status"):
        models.evaluate_router(df.withColumn("status", F.lit("x")), "grp", "ts", "id", ["status"])


def test_problem_metrics(spark):
    p = spark.createDataFrame([("Closed", True), ("Open", None), (None, False)], "status string, has_resolution boolean")
    assert tuple(analytics.problem_metrics(p).first())[:2] == (3, 1) and analytics.problem_metrics(p.select("status").where("false")).first() == (0, 0, 0.0)
    shown = p.limit(1).select(*[analytics.shown(F.lit(v), f) for v, f in ((1234567, "count"), (12.4, "percent"), (1.25, "hours"))], analytics.shown(F.lit(None).cast("double"), "hours")).first()
    assert tuple(shown)[:2] == ("1,234,567", "12%") and shown[3] == "—"


def test_char_gram_counts_are_those_of_the_column_function(spark, monkeypatch):
    """Keys that are null, repeated and cut by pieces, letters of many scripts, separators that are no white space, and no piece of more than a few texts."""
    from pyspark.sql import functions as F
    from tidemark.functions import text as X
    from tidemark.operators import retrieval as R

    texts = ["a bb  ccc\u00a0Dddd eeeee", "", None, "\u2003x\u3000\u0130y 😀😀 ß", "a\x1cb c\x1fd\x85e", "".join(map(chr, range(0x4E00, 0x4E00 + 7000))), "a\0 \0b\0", "word " * 300]
    rows = [(k, t) for k in (1, 1, 2, None, None, 3) for t in texts] + [(4, "one"), (5, None), (6, "  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = R.term_counts(df, "doc_id", X.char_ngrams(F.col("text"))).collect()
    assert sorted(map(repr, R.char_gram_counts(df, "doc_id", F.col("text")).collect())) == sorted(map(repr, want)) and len(want) > 100_000
    import pyarrow as pa

    monkeypatch.setattr(R, "PIECE_CHARS", 50)
    rows = sorted((r for r in rows if r[1] is None or len(r[1]) < 2000), key=lambda r: (r[0] is not None, r[0]))
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in own], pa.int64()), pa.array([r[1] and r[1].lower() for r in own], pa.string())], names=["doc_id", "text"]) for own in (rows[:7], rows[7:8], rows[8:8], rows[8:])]
    few = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((tuple(r) for r in R.term_counts(few, "doc_id", X.char_ngrams(F.col("text"))).collect()), key=repr)
    assert sorted(((r["doc_id"], *g.values()) for b in R._char_grams(batches, 2, 5) for r in b.to_pylist() for g in r["found"]), key=repr) == want


def test_vectors_move_no_counts(spark):
    """Parts name their grams once and are told their frequencies: the same weights as by counts, with keys that are null, repeated or without a gram."""
    import random

    import numpy as np
    from pyspark.sql import functions as F
    from tidemark.functions import text as X
    from tidemark.operators import retrieval as R

    r = random.Random(4)
    rows = [(i // 2 if i % 10 == 0 else i, " ".join(r.choices("ab cd ef gh ij kl mn op".split(), k=r.randrange(1, 700 if i % 50 == 0 else 9)))) for i in range(300)]
    rows += [(None, "ab cd xx"), (None, "xx yy"), (500, None), (501, ""), (502, "a b"), (503, "only here")]
    df, grams = spark.createDataFrame(rows, "doc_id long, text string"), X.word_ngrams(F.col("text"))
    want = {}
    for x in R.weights(R.term_counts(df, "doc_id", grams), "doc_id").select("doc_id", F.xxhash64("gram").alias("g"), "w").where("doc_id is not null").collect():
        want.setdefault(x.doc_id, {})[x.g] = x.w
    found = R.vectors(df, "doc_id", grams)
    got = {x.doc_id: dict(zip(x.grams, x.w)) for x in found.collect()}
    assert got.keys() == want.keys() and all(got[k].keys() == want[k].keys() and all(abs(w - want[k][g]) < 1e-12 for g, w in got[k].items()) for k in want)
    some = {x.doc_id: dict(zip(x.grams, x.w)) for x in R.vectors(df, "doc_id", grams, asked=F.col("doc_id") % 100 == 3).collect()}
    asked = {g for k in want if k % 100 == 3 for g in want[k]}
    assert some.keys() == want.keys() and all(some[k].keys() == want[k].keys() & asked and all(abs(w - want[k][g]) < 1e-12 for g, w in some[k].items()) for k in want)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        hashes, numbers = np.unique(rng.integers(-(2**63), 2**63, n)), rng.choice([0, 3, 254, 255, 256, 10**6], n)
        hashes = np.sort(hashes)
        own = [h for h in (hashes[hashes < 0], hashes[hashes >= 0])]
        assert all((R._stepped(R._steps(h), len(h)) == h).all() for h in own) and (R._long(R._short(numbers), n) == numbers).all()


def test_index_of_all_grams_counts_no_strings(spark, tmp_path, monkeypatch):
    """An index without a limit of grams is written without rows of counts, and answers as the search that has none; a limit above all grams changes nothing."""
    from pyspark.sql import functions as F
    from tidemark.functions import text as X
    from tidemark.operators import retrieval as R

    rows = [(i, f"word{i % 7} word{i % 5} common word{i % 3} other{i}") for i in range(60)]
    df, grams = spark.createDataFrame(rows, "doc_id long, text string"), X.word_ngrams(F.col("text"))
    v = R.vectors(df, "doc_id", grams)
    want = sorted(tuple(r) for r in R.similar_vectors(v.where("doc_id % 10 = 0"), v, "doc_id").collect())
    ask = lambda folder: sorted(tuple(r)[1::-1] + tuple(r)[2:] if r.__fields__[0] == "doc_id" else tuple(r) for r in R.query_index(df.where("doc_id % 10 = 0"), "doc_id", grams, folder, leave_one_out=True).collect())
    R.build_index(df, "doc_id", grams, str(tmp_path / "limited"), max_features=10**6)
    counted, real = [], R.term_counts
    monkeypatch.setattr(R, "term_counts", lambda *a, **b: counted.append(1) or real(*a, **b))
    R.build_index(df, "doc_id", grams, str(tmp_path / "all"), max_features=None)
    assert not counted and len(want) == 30
    assert ask(str(tmp_path / "all")) == ask(str(tmp_path / "limited")) == want
