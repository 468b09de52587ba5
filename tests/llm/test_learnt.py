"""Learnt operators: gradients, edge cases, held-out accuracy; and the pipeline's stages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def worst_error(net, gradients, scale):
    """The largest relative difference between gradients and central differences."""
    r, worst = np.random.default_rng(0), 0.0
    _, g = gradients()
    for k in net.p:
        for _ in range(4):
            i = tuple(r.integers(0, s) for s in net.p[k].shape)
            old = net.p[k][i]
            net.p[k][i] = old + scale
            a = gradients()[0]
            net.p[k][i] = old - scale
            b = gradients()[0]
            net.p[k][i] = old
            num = (a - b) / 2 / scale
            worst = max(worst, abs(num - g[k][i]) / (abs(num) + abs(g[k][i]) + 1e-4))
    return worst


def test_toxicity_gradients():
    net = toxicity.Network(["idiot", "the"], 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    unique, rows = toxicity.numbered([["the", "idiot", "abc", "x"], ["q"], ["the"] * 32, []])
    assert worst_error(net, lambda: net.gradients(unique, rows, np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 1, 1])), 1e-4) < 1e-4


def test_quality_gradients():
    net, x = quality.Network(1), np.random.default_rng(0).random((9, quality.FEATURES))
    bag = np.array([0, 0, 0, 1, 2, 2, 2, 2, 2])
    assert worst_error(net, lambda: net.gradients(x, bag, np.array([1.0, 0, 1]), np.array([1.0, 2, 1])), 1e-5) < 1e-4


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 500):
        starts = toxicity.window_starts(n)
        assert set(range(n)) <= {i for s in starts for i in range(s, s + toxicity.WINDOW)} and all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_scores_do_not_depend_on_company():
    net = toxicity.Network(["a", "b"], 3)
    texts = ["a b c " * 40, "", None, "zebra", "b " * 33, "x" * 500]
    alone = [toxicity.Scorer(net)([t])[0] for t in texts]
    together = toxicity.Scorer(net)(texts)
    assert np.allclose(alone, together, atol=1e-6)
    small = toxicity.Scorer(net, most=200)  # too small a store: texts go in runs and in parts
    assert np.allclose(small(texts + ["q w e r t " * 90]), toxicity.Scorer(net)(texts + ["q w e r t " * 90]), atol=1e-6)
    # all windows count: what is toxic at the very end is found
    rows = [["fine", str(i % 7)] * 10 + ["bad"] * (i % 2) for i in range(2400)]
    net = toxicity.train([[r] for r in rows], [i % 2 for i in range(2400)])
    low, high = toxicity.Scorer(net)(["fine 1 " * 4000, "fine 1 " * 4000 + "bad"])
    assert high > 0.7 > low


def test_scores_of_many_words_after_a_short_text():
    net = toxicity.Network(["a", "b"], 3)
    wide = lambda n, c: " ".join(c + "".join(chr(97 + int(d)) for d in str(i)) for i in range(n))
    texts = ["a b", wide(500, "x"), "b a b", wide(101, "y"), wide(99, "z"), "a", wide(300, "q")]
    assert len(set(toxicity.words(texts[1]))) == 500
    alone = [toxicity.Scorer(net)([t])[0] for t in texts]
    assert np.allclose(toxicity.Scorer(net, most=200)(texts), alone, atol=1e-6)


@pytest.mark.parametrize("op", [quality, toxicity])
def test_held_out_accuracy(spark, op):
    import tidemark.llm.common as common

    label = "quality" if op is quality else "toxic"
    rows = op.query(spark, SF).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r[label] for r in common.table(spark, SF, "labels").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    # about 400 labelled rows in all, some of them mislabelled; the larger tables give better
    scores = np.array([r.score for r in rows if r.held_out and r.doc_id in truth])
    said = np.array([truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth])
    ranks = np.empty(len(scores))
    ranks[np.argsort(scores)] = np.arange(1, len(scores) + 1)
    ones = said == 1
    area = (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    hit, given = sum(p and t for p, t in held), sum(p for p, _ in held)
    assert area > 0.85 and hit / ones.sum() >= 0.5 and hit / given >= 0.85
    assert sum(p == t for p, t in held) / len(held) > max(ones.mean(), 1 - ones.mean())  # better than one answer for all


def test_repeated_ids_do_not_grow_the_sample(spark):
    docs = spark.range(3000).selectExpr("id % 2 as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.training_rows(docs, labels, 20, 30).groupBy("toxic").count().count() <= 2
    assert toxicity.training_rows(docs, labels, 20, 30).count() <= 50 and quality.training_rows(docs, labels, 20).count() <= 40


def test_score_replaces_a_column_of_its_name(spark):
    docs = spark.createDataFrame([(1, "a b", "old")], "doc_id long, text string, score string")
    for op, net in ((toxicity, toxicity.Network(["a"], 0)), (quality, quality.fit(docs, docs.selectExpr("doc_id", "1 as quality").where("false")))):
        got = op.score(docs, net)
        assert got.columns.count("score") == 1 and 0 <= got.first()["score"] <= 1


@pytest.mark.parametrize("op", [quality, toxicity])
def test_edge_rows(spark, op):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (4, "y"), (4, "y"), (5, "z " * 40000)], "doc_id long, text string").withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false")):
        net = op.fit(docs, known)
        assert op.score(docs, net).count() == 6
    assert op.score(docs.where("false"), net).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as pipe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.where("doc_id < 3").select((F.col("doc_id") + 5000).alias("doc_id"), "text", "lang", "source", "n_chars")
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id = 0"))
    before = columns = docs.columns
    for name, stage in pipe.STAGES:
        kept = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert docs.columns == columns and docs.select("doc_id").subtract(kept.select("doc_id")).count() == 0
        if name == "simhash_dedup":
            assert docs.where("doc_id >= 5000").count() == 0 and docs.groupBy("doc_id").count().where("count > 1").count() == 0
        if name == "pii":
            assert docs.where(F.col("text").rlike(r"[A-Za-z0-9]@[a-z0-9-]+\.[a-z]")).count() == 0
    assert before == columns and docs.where("n_tokens <> size(ids)").count() == 0 and docs.count() > 800


def test_pipeline_judges_each_row_by_its_text(spark, tmp_path):
    import corpus_pipeline as pipe

    leak, clean = "the small grey cat sat on the old mat in a warm room all day long", "a clean text about nothing that any question asks of anyone"
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, leak), (1, clean), (None, leak), (None, clean), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.doc_id, x.text) for x in pipe.drop_benchmark(spark, docs, str(tmp_path)).collect()}
    assert got == set(rows) - {(1, leak), (None, leak)}
    # of a doc_id's two texts, the copy of a smaller doc_id goes and the other stays; so do rows without a doc_id
    rows = [(0, leak), (5, leak), (5, clean), (None, clean), (None, "alone"), (None, "alone"), (6, "once more"), (6, "ONCE  more")]
    got = sorted(pipe.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect(), key=repr)
    assert [(x.doc_id, x.text) for x in got if x.doc_id != 6] == [(0, leak), (5, clean), (None, "alone")] and len(got) == 4


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, extra columns with clashing names, an empty table."""
    import corpus_pipeline as pipe

    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (None, "x y z"), (None, None), (4, "mail a@b.cc now"), (5, "w " * 60000 + "end"), (6, "é 日本 \x00 \t\n z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "h": F.lit("h"), "kind": F.lit(None).cast("int"), "start": F.lit(1.5), "k": F.lit(True), "n_chars": F.length("text").cast("long"), "key": F.lit("y"), "t": F.lit(0)})
    left = {"toxicity": 9, "simhash_dedup": 6, "decontaminate": 9, "pii": 9, "bpe": 9}
    for name, stage in pipe.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        # a row without text, a blank one and the long one are all distinct texts or copies of each other, as the stages say
        assert got.count() == left[name], name
        if name != "bpe":
            assert got.columns == docs.columns
        if name == "pii":
            assert {r.text for r in got.where("doc_id = 4").collect()} == {"mail [EMAIL] now"} and got.where("doc_id = 4").first().n_chars == 16
            assert got.where("doc_id = 2").first().text is None and got.where("doc_id = 5").first().text == rows[7][1]
        if name == "bpe":
            assert {r.doc_id: r.n_tokens for r in got.collect()}[3] == 0
        none = stage(spark, docs.where("false"), SF)
        assert none.count() == 0 and (name == "bpe" or none.columns == docs.columns)
