"""Quality by attention-based multiple-instance learning, in numpy.

A text is cut into passages of ``PASSAGE`` words; every passage becomes a vector of counts and shares
(classes of characters, marks, repeated words; not which words they are) and is encoded by a layer. Gated attention,
softmax(w . (tanh(V h) * sigmoid(U h))), weighs the passages, and a logistic unit scores their
weighted mean. Only labels of whole texts train it.

Training takes at most ``ROWS`` labelled rows of each class, those with the smallest hashes of doc_id,
with all their passages. Scoring takes all passages of all texts, whose weights are summed as they
come, so memory does not grow with the text.

Edge cases: a null or empty text is one passage without words; null doc_ids stay null and are never
trained on; of rows with one doc_id, and of repeated or contradicting labels, as many are taken as the
sample's bound leaves; without labelled rows of both classes every score is 0.5; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, map_rows, table
from tidemark.llm.neural import Adam, sigmoid

QUERY = "op9_attention_quality"
PASSAGE = 64
ROWS = 1500
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH = 30, 64
THRESHOLD = 0.7

#: Class of each byte: lower-case letter, capital, digit, blank, line end, byte of a longer character, control, then each ASCII mark.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = np.full(256, 6)
CLASSES[ord("a") : ord("z") + 1], CLASSES[ord("A") : ord("Z") + 1], CLASSES[ord("0") : ord("9") + 1] = 0, 1, 2
CLASSES[ord(" ")], CLASSES[ord("\n")], CLASSES[128:] = 3, 4, 5
for _i, _c in enumerate(MARKS):
    CLASSES[ord(_c)] = 7 + _i
FEATURES = 7 + len(MARKS) + 6


def passages(text: str | None) -> np.ndarray:
    """A vector for each passage (passages, FEATURES)."""
    words = (text or "").encode("utf-8", "surrogatepass").split(b" ")
    out = np.zeros((-(-len(words) // PASSAGE), FEATURES), np.float32)
    for k in range(len(out)):
        own = words[k * PASSAGE : (k + 1) * PASSAGE]
        raw = b" ".join(own)
        n, size = len(own), max(1, len(raw))
        counts = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=7 + len(MARKS))
        out[k, : len(counts)] = np.sqrt(counts / size)
        # the words before the passage's first one are part of the text: repetition goes on over its start
        before = words[k * PASSAGE - 1 : (k + 1) * PASSAGE - 1] if k else own[:-1]
        same = sum(map(operator.eq, own if k else own[1:], before))
        out[k, -6:] = same / n, len(set(own)) / n, min(size / n / 10, 3), n / PASSAGE, min(max(map(len, own)) / 40, 3), min(len(words) / 400, 2)
    return out


class Network:
    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        mat = lambda *s: r.standard_normal(s) / np.sqrt(s[0])
        self.p = {"w1": mat(FEATURES, HIDDEN), "b1": np.zeros(HIDDEN), "v": mat(HIDDEN, ATTENTION), "u": mat(HIDDEN, ATTENTION), "w": mat(ATTENTION), "out": mat(HIDDEN), "bias": np.zeros(1)}
        self.mean, self.spread, self.ready = np.zeros(FEATURES), np.ones(FEATURES), True

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(encoded passages, their attention before the softmax)."""
        p = self.p
        h = np.tanh((x - self.mean) / self.spread @ p["w1"] + p["b1"])
        return h, (np.tanh(h @ p["v"]) * sigmoid(h @ p["u"])) @ p["w"]

    def gradients(self, x: np.ndarray, bag: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for passages x, of the texts whose numbers ``bag`` gives in ascending order."""
        p = self.p
        x = (x - self.mean) / self.spread
        h = np.tanh(x @ p["w1"] + p["b1"])
        t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * s) @ p["w"]
        firsts = np.searchsorted(bag, np.arange(len(labels)))
        top = np.maximum.reduceat(e, firsts)
        a = np.exp(e - top[bag])
        a /= np.add.reduceat(a, firsts)[bag]
        z = np.add.reduceat(a[:, None] * h, firsts)
        prob = sigmoid(z @ p["out"] + p["bias"])
        loss = -(weights * (labels * np.log(prob + 1e-9) + (1 - labels) * np.log(1 - prob + 1e-9))).sum() / weights.sum()
        d = (prob - labels) * weights / weights.sum()
        dz = d[:, None] * p["out"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, firsts)[bag])
        dt, ds = de[:, None] * p["w"] * s, de[:, None] * p["w"] * t
        dv, du = dt * (1 - t * t), ds * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dv @ p["v"].T + du @ p["u"].T) * (1 - h * h)
        return float(loss), {"w1": x.T @ dh, "b1": dh.sum(0), "v": h.T @ dv, "u": h.T @ du, "w": (t * s).T @ de, "out": z.T @ d, "bias": d.sum(keepdims=True)}

    def score(self, text: str | None) -> float:
        if not self.ready:
            return 0.5
        h, e = self.encode(passages(text))
        a = np.exp(e - e.max())
        return float(sigmoid((a @ h / a.sum()) @ self.p["out"] + self.p["bias"])[0])


def train(bags: list[np.ndarray], labels: list[int], seed: int = 0) -> Network:
    net = Network(seed)
    if len(set(labels)) < 2:
        net.ready = False
        return net
    y = np.array(labels, float)
    flat = np.concatenate(bags).astype(float)
    net.mean, net.spread = flat.mean(0), flat.std(0) + 0.05
    weights = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5  # half way to equal classes
    r, adam = np.random.default_rng(seed), Adam(net.p, 0.01)
    for epoch in range(EPOCHS):
        adam.rate = 0.01 * 0.93**epoch
        order = r.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            _, grads = net.gradients(np.concatenate([bags[i] for i in own]).astype(float), np.repeat(np.arange(len(own)), [len(bags[i]) for i in own]), y[own], weights[own])
            for k in ("w1", "v", "u", "out"):
                grads[k] = grads[k] + 1e-4 * net.p[k]
            adam.step(grads)
    return net


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(doc_id, text, quality) of the bounded sample of rows that may be learnt from."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    first = [known.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    sample = F.broadcast(first[0].unionByName(first[1]))  # at most 2 * rows rows
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    # once more, for doc_ids may be repeated
    return bounded(found, "quality", ((0, rows), (1, rows)))


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    def batch(b):
        bags = [passages(t) for t in b.column(1).to_pylist()]
        return {"doc_id": b.column(0), "quality": b.column(2), "bag": [x.astype("<f4").tobytes() for x in bags]}

    rows = map_rows(training_rows(docs, labels), batch, "doc_id long, quality int, bag binary").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, r.quality, bytes(r.bag)))
    return train([np.frombuffer(r.bag, "<f4").reshape(-1, FEATURES) for r in rows], [r.quality for r in rows])


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): how likely each text's quality label is 1."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def batch(b):
        return {"doc_id": b.column(0), "score": pa.array([sent.value.score(t) for t in b.column(1).to_pylist()], pa.float64())}

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), batch, "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
