"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's characters are read in both directions and pooled by attention; that vector and, for words of
the vocabulary, an embedding are the word's input. Windows of ``WINDOW`` words that overlap by half
are read in both directions and pooled by attention again; a text's score is that of its worst window,
put through a logistic fit to the labels of whole texts. All windows of a text are scored. A run of
over ``LETTERS`` letters counts as several words.

Training takes a bounded sample of labelled rows, ``TOXIC_ROWS`` and ``CLEAN_ROWS`` with the smallest
hashes of doc_id, with their whole texts. A label holds for a text, so it must be found out which words
and windows it speaks of. First the characters' part learns to tell words that occur in toxic texts far
more often than chance allows (``SEED_Z`` standard deviations) from others, and the words' inputs start
on the direction that this gives. Then rounds follow: from every toxic and every clean text the
``WORST`` windows by the network so far, and some others of clean texts, are learnt; at first with the
characters' part as it is, which is quick, and then with all parts. A quarter of the texts is not
learnt from, but gives the scale and the level of the score.

Edge cases: a null or empty text is one window without words; null doc_ids stay null and are never
trained on; of rows with one doc_id, and of repeated or contradicting labels, as many are taken as the
sample's bound leaves; without labelled rows of both classes every score is 0; an empty table gives an
empty result; other columns are ignored, but for one with the score's name, which is replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, map_arrow, table
from tidemark.llm.neural import Adam, attend, attend_back, gru, gru_back, sigmoid, sums_by_row

QUERY = "op10_bigru_toxicity"
WINDOW, STRIDE, LETTERS = 32, 16, 16
TOXIC_ROWS, CLEAN_ROWS = 500, 1300
VOCABULARY, LEAST_ROWS = 4000, 6
HIDDEN, CHAR_HIDDEN, ATTENTION = 8, 8, 8
#: Words that the characters' part learns from, the excess from which one is a seed, and the rounds.
SEED_WORDS, SEED_Z, SEED_EPOCHS = 12_000, 4.0, 8
# Rounds of windows with and then without the characters' part fixed; windows of a text in each; batches.
EPOCHS, FINE_EPOCHS, WORST, BATCH, FINE_BATCH, RATE, DECAY = 8, 2, 4, 128, 512, 0.02, 1e-4
#: One text in VALID is kept to tell the scores of toxic texts, and so which logit is to be THRESHOLD.
VALID, THRESHOLD = 4, 0.7
LEVEL = float(np.log(THRESHOLD / (1 - THRESHOLD)))
WORD = re.compile(rf"[^\W_]{{1,{LETTERS}}}")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789äöüßéèêëàâçîïôùûáíóúñ"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def window_starts(n: int) -> list[int]:
    """Starts of overlapping windows over n words; every word is in one at least."""
    return [*range(0, max(1, n - WINDOW + STRIDE), STRIDE)] if n > WINDOW else [0]


CHARS = {c: i + 1 for i, c in enumerate(ALPHABET)}


def spelled(unique: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character numbers (LETTERS, words), and how many each word has."""
    out = np.zeros((len(unique), LETTERS), np.int64)
    sizes = np.array([len(w) for w in unique], np.int64)
    for i, w in enumerate(unique):
        out[i, : len(w)] = [CHARS.get(c, 0) for c in w]
    return out.T, sizes


class Network:
    """Parameters by name; c: characters, w: words; f and b: directions."""

    def __init__(self, vocabulary: list[str], seed: int = 0):
        r = np.random.default_rng(seed)
        mat = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.p = {"out": mat(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"cx{d}": mat(len(ALPHABET) + 1, 3 * CHAR_HIDDEN), f"cu{d}": mat(CHAR_HIDDEN, 3 * CHAR_HIDDEN)}
            self.p |= {f"we{d}": mat(len(vocabulary) + 1, 3 * HIDDEN) * 0.3, f"wc{d}": mat(2 * CHAR_HIDDEN, 3 * HIDDEN), f"wu{d}": mat(HIDDEN, 3 * HIDDEN)}
        for k, h in (("c", CHAR_HIDDEN), ("w", HIDDEN)):
            self.p |= {f"{k}aw": mat(2 * h, ATTENTION), f"{k}ab": np.zeros(ATTENTION, np.float32), f"{k}av": mat(ATTENTION)}
        self.scale, self.shift, self.ready = 1.0, 0.0, True

    def ids(self, unique: list[str]) -> np.ndarray:
        return np.array([self.vocabulary.get(w, 0) for w in unique], np.int64)

    def read_chars(self, unique: list[str], keep: bool = False):
        """Vectors (words, 2 CHAR_HIDDEN) of words; those of equal length go together."""
        p, out, kept = self.p, np.zeros((len(unique), 2 * CHAR_HIDDEN), self.p["cuf"].dtype), []
        chars, sizes = spelled(unique)
        for n in np.unique(sizes):
            for own in np.array_split(np.flatnonzero(sizes == n), max(1, int((sizes == n).sum()) // 8192)):
                c = chars[:n, own]
                f, b = gru(p["cxf"][c], None, p["cuf"], keep), gru(p["cxb"][c[::-1]], None, p["cub"], keep)
                hs = np.concatenate([f[0], b[0][::-1]] if keep else [f, b[::-1]], 2)
                got = attend(hs, None, p["caw"], p["cab"], p["cav"], keep)
                out[own] = got[0] if keep else got
                if keep:
                    kept.append((own, c, hs, f[1], b[1], got[1]))
        return (out, kept) if keep else out

    def read_chars_back(self, d_vec: np.ndarray, kept: list) -> dict[str, np.ndarray]:
        p = self.p
        g = {k: np.zeros_like(p[k]) for k in p if k.startswith("c")}
        for own, c, hs, kf, kb, pooled in kept:
            d_hs, *rest = attend_back(d_vec[own], hs, p["caw"], p["cav"], pooled)
            for k, v in zip(("caw", "cab", "cav"), rest):
                g[k] += v
            for d, states, part, at in (("f", kf, d_hs[..., :CHAR_HIDDEN], c), ("b", kb, d_hs[::-1, :, CHAR_HIDDEN:], c[::-1])):
                dx, du = gru_back(part, None, p[f"cu{d}"], states)
                g[f"cu{d}"] += du
                g[f"cx{d}"] += sums_by_row(at.ravel(), dx.reshape(-1, 3 * CHAR_HIDDEN), len(p[f"cx{d}"]))
        return g

    def word_inputs(self, unique: list[str]) -> dict[str, np.ndarray]:
        """The inputs (words, 3 HIDDEN) of both directions."""
        vec, ids = self.read_chars(unique), self.ids(unique)
        return {d: self.p[f"we{d}"][ids] + vec @ self.p[f"wc{d}"] for d in "fb"}

    def logits(self, x: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
        """Logits of windows given as word numbers (windows, WINDOW); number 0 is no word."""
        out = np.empty(len(rows), np.float32)
        p = self.p
        for at in range(0, len(rows), 2048):
            w = rows[at : at + 2048].T
            mask = None if w.all() else w > 0
            hs = np.concatenate([gru(x["f"][w], mask, p["wuf"]), gru(x["b"][w[::-1]], None if mask is None else mask[::-1], p["wub"])[::-1]], 2)
            out[at : at + w.shape[1]] = attend(hs, mask, p["waw"], p["wab"], p["wav"]) @ p["out"] + p["bias"]
        return out

    def gradients(self, unique: list[str], rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, vec: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for windows of numbers 1.. of the words in ``unique``, 0 for no word.

        With ``vec``, the words' vectors (the first for no word), the characters' part is left as it is.
        """
        p, g, kept = self.p, {}, None
        if vec is None:
            vec, kept = self.read_chars(unique, keep=True)
            vec = np.vstack([np.zeros((1, vec.shape[1]), vec.dtype), vec])
        ids = np.append(0, self.ids(unique))
        w = rows.T
        mask = w > 0
        x = {d: p[f"we{d}"][ids] + vec @ p[f"wc{d}"] for d in "fb"}
        hf, mf = gru(x["f"][w], mask, p["wuf"], keep=True)
        hb, mb = gru(x["b"][w[::-1]], mask[::-1], p["wub"], keep=True)
        hs = np.concatenate([hf, hb[::-1]], 2)
        pooled, w_kept = attend(hs, mask, p["waw"], p["wab"], p["wav"], keep=True)
        prob = sigmoid(pooled @ p["out"] + p["bias"])
        loss = -(weights * (labels * np.log(prob + 1e-7) + (1 - labels) * np.log(1 - prob + 1e-7))).sum() / weights.sum()
        d = ((prob - labels) * weights / weights.sum()).astype(p["out"].dtype)
        g["out"], g["bias"] = pooled.T @ d, d.sum(keepdims=True)
        dhs, g["waw"], g["wab"], g["wav"] = attend_back(d[:, None] * p["out"], hs, p["waw"], p["wav"], w_kept)
        d_vec = np.zeros_like(vec)
        for k, states, part, at, m in (("f", mf, dhs[..., :HIDDEN], w, mask), ("b", mb, dhs[::-1, :, HIDDEN:], w[::-1], mask[::-1])):
            dx, g[f"wu{k}"] = gru_back(part, m, p[f"wu{k}"], states)
            by_word = sums_by_row(at.ravel(), dx.reshape(-1, 3 * HIDDEN), len(ids))
            by_word[0] = 0
            g[f"wc{k}"] = vec.T @ by_word
            d_vec += by_word @ p[f"wc{k}"].T
            g[f"we{k}"] = sums_by_row(ids, by_word, len(p[f"we{k}"]))
        return float(loss), g if kept is None else g | self.read_chars_back(d_vec[1:], kept)


def numbered(windows: list[list[str]]) -> tuple[list[str], np.ndarray]:
    """(the words, windows of their numbers from 1)."""
    number: dict[str, int] = {}
    rows = np.zeros((len(windows), WINDOW), np.int64)
    for i, w in enumerate(windows):
        rows[i, : len(w)] = [number.setdefault(x, len(number) + 1) for x in w]
    return list(number), rows


def learn_words(net: Network, counts: dict[str, list[int]], sizes: list[int], r: np.random.Generator) -> tuple[np.ndarray, float]:
    """Teach the characters' part to tell seeds from other words; the direction and offset that do so.

    ``counts``: the clean and toxic texts that have a word; ``sizes``: all clean and toxic texts.
    """
    words_ = sorted(counts, key=lambda w: (-sum(counts[w]), w))[:SEED_WORDS]
    seen = np.array([counts[w] for w in words_], float).reshape(-1, 2)
    share, n = sizes[1] / sum(sizes), seen.sum(1)
    z = (seen[:, 1] - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)
    y = (z > SEED_Z).astype(np.float32)
    weight = np.where(y == 1, np.minimum(z, 2 * SEED_Z), 1.0)
    weight = np.where(y == 1, weight * (y == 0).sum() / max(1e-9, weight[y == 1].sum()), weight)
    own = {"r": np.zeros(2 * CHAR_HIDDEN, np.float32), "r0": np.zeros(1, np.float32)} | {k: v for k, v in net.p.items() if k.startswith("c")}
    adam = Adam(own)
    for epoch in range(SEED_EPOCHS if y.any() else 0):
        adam.rate = 1.5 * RATE * 0.85**epoch
        order = r.permutation(len(words_))
        for at in range(0, len(order), FINE_BATCH):
            k = order[at : at + FINE_BATCH]
            vec, kept = net.read_chars([words_[i] for i in k], keep=True)
            d = ((sigmoid(vec @ own["r"] + own["r0"]) - y[k]) * weight[k] / weight[k].sum()).astype(np.float32)
            adam.step({"r": vec.T @ d, "r0": d.sum(keepdims=True)} | net.read_chars_back(d[:, None] * own["r"], kept))
    return own["r"], float(own["r0"][0])


def worst_windows(scores: np.ndarray, owner: np.ndarray, most: int) -> np.ndarray:
    """Numbers of each text's windows with the highest scores, ``most`` a text."""
    order = np.lexsort((-scores, owner))
    at = np.arange(len(order))
    first = np.maximum.accumulate(np.where(np.r_[True, np.diff(owner[order]) != 0], at, 0))
    return order[at - first < most]


def train(texts: list[list[list[str]]], labels: list[int], seed: int = 0, epochs: int = EPOCHS) -> Network:
    """A network from texts' windows and the texts' labels."""
    label = np.array(labels)
    valid = np.zeros(len(texts), bool)
    for c in (0, 1):
        valid[np.flatnonzero(label == c)[VALID - 1 :: VALID]] = True
    counts: dict[str, list[int]] = {}
    for windows, c in ((t, c) for t, c, v in zip(texts, labels, valid) if not v):
        for w in {x for window in windows for x in window}:
            counts.setdefault(w, [0, 0])[c] += 1
    common = sorted((w for w, n in counts.items() if sum(n) >= LEAST_ROWS), key=lambda w: (-sum(counts[w]), w))[:VOCABULARY]
    net = Network(common, seed)
    if len(set(labels)) < 2:
        net.ready = False
        return net
    r = np.random.default_rng(seed)
    sizes = [int((label[~valid] == c).sum()) for c in (0, 1)]
    direction, offset = learn_words(net, counts, sizes, r)
    # the words' inputs start on one direction: what the characters tell, and how often a known word was in toxic texts
    odds = lambda n: np.log((n[1] * sizes[0] / sizes[1] + 1) / (n[0] + 1)) * min(1.0, sum(n) / 8)
    told = np.array([0.0, *(odds(counts[w]) for w in common)], np.float32)
    for d in "fb":
        v = (r.standard_normal(3 * HIDDEN) * 0.5).astype(np.float32)
        net.p[f"wc{d}"] = (np.outer(direction, v) * 0.3 + r.standard_normal((2 * CHAR_HIDDEN, 3 * HIDDEN)) * 0.1).astype(np.float32)
        net.p[f"we{d}"] = (told[:, None] * v * 0.3 + r.standard_normal((len(told), 3 * HIDDEN)) * 0.03).astype(np.float32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    unique, rows = numbered([w for windows in texts for w in windows])
    if not unique:
        net.ready = False
        return net
    ids = np.append(0, net.ids(unique))
    vec = np.vstack([np.zeros((1, 2 * CHAR_HIDDEN), np.float32), net.read_chars(unique)])
    bad = np.maximum(0, vec @ direction + offset + told[ids])
    bad[0] = 0
    scores, known = np.sort(bad[rows], 1)[:, -3:].sum(1), False
    others = np.flatnonzero(~valid[owner] & (label[owner] == 0))
    adam = Adam(net.p)
    for epoch in range(epochs + FINE_EPOCHS):
        fine = epoch >= epochs
        if epoch in (epochs // 2, epochs):
            scores, known = net.logits({d: net.p[f"we{d}"][ids] + vec @ net.p[f"wc{d}"] for d in "fb"}, rows), True
        used = worst_windows(scores, owner, WORST)
        used = used[~valid[owner[used]]]
        used = np.concatenate([used, r.choice(others, min(len(others), len(used) // 3), replace=False)])
        y = label[owner[used]].astype(np.float32)
        # a toxic text's window counts by how toxic it seems by now
        weight = np.where((y == 1) & known, np.maximum(0.05, sigmoid(scores[used])), 1.0)
        weight = np.where(y == 1, weight * (y == 0).sum() / max(1e-9, weight[y == 1].sum()), weight).astype(np.float32)
        adam.rate = RATE * 0.85**epoch
        order = r.permutation(len(used))
        size = FINE_BATCH if fine else BATCH
        for at in range(0, len(order), size):
            own = order[at : at + size]
            some, small = np.unique(np.append(0, rows[used[own]].ravel()), return_inverse=True)
            _, grads = net.gradients([unique[i - 1] for i in some[1:]] or ["a"], small[1:].reshape(len(own), -1), y[own], weight[own], None if fine else vec[some] if len(some) > 1 else np.zeros((2, vec.shape[1]), np.float32))
            adam.step({k: g + DECAY * net.p[k] for k, g in grads.items()})
    apart = np.flatnonzero(valid[owner]) if valid.any() else np.arange(len(owner))
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, owner[apart], net.logits(stacked(net.word_inputs(unique)), rows[apart]))
    there = np.isfinite(best)
    if len(set(label[there].tolist())) == 2:
        net.scale, _ = logistic(best[there], label[there].astype(float))
        net.scale = max(net.scale, 0.1)
        net.shift = LEVEL - net.scale * cut(best[there], label[there])
    return net


def cut(x: np.ndarray, y: np.ndarray) -> float:
    """The value of x from which y is 1, at the best F measure, in which precision weighs more than recall."""
    order = np.argsort(-x, kind="stable")
    hits, all_ = np.cumsum(y[order] == 1), np.arange(1, len(x) + 1)
    f = hits / (0.5 * (y == 1).sum() + all_)
    k = int(np.flatnonzero(f == f.max())[-1])
    above, below = x[order[k]], x[order[min(k + 1, len(x) - 1)]]
    return float(0.5 * (above + below))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit with a little shrinkage."""
    mean, spread = x.mean(), x.std() + 1e-6
    z, w = (x - mean) / spread, 1 / len(x)
    a = b = 0.0
    for _ in range(50):
        p = sigmoid(a * z + b)
        g = np.array([(w * (p - y) * z).sum() + 1e-3 * a, (w * (p - y)).sum()])
        s = w * p * (1 - p)
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-9))
        a, b = a - step[0], b - step[1]
    return float(a / spread), float(b - a * mean / spread)


def stacked(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Words' inputs with a first row for no word."""
    return {d: np.vstack([np.zeros((1, 3 * HIDDEN), np.float32), v]) for d, v in x.items()}


class Scorer:
    """Scores texts; the inputs of words met before are kept, up to a bound."""

    def __init__(self, net: Network, most: int = 120_000):
        self.net, self.most = net, most
        self.number: dict[str, int] = {}
        self.x = {d: np.zeros((most + 1, 3 * HIDDEN), np.float32) for d in "fb"}

    def _learn(self, new: list[str]) -> None:
        got, n = self.net.word_inputs(new), len(self.number)
        for d in "fb":
            self.x[d][n + 1 : n + 1 + len(new)] = got[d]
        for i, w in enumerate(new):
            self.number[w] = n + 1 + i

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text."""
        if not self.net.ready:
            return np.zeros(len(texts))
        best = np.empty(len(texts))
        for i, at in self._runs(texts):
            best[i : i + len(at)] = at
        return sigmoid(self.net.scale * best + self.net.shift)

    def _runs(self, texts: list):
        """(first text, best logits) of runs of texts; a text with too many different words goes in parts."""
        i, ahead = 0, None
        while i < len(texts):
            held, size, j = [], 0, i
            while j < len(texts):
                own = words(texts[j]) if ahead is None else ahead
                if held and size + len(own) > self.most // 2:
                    ahead = own  # opens the next run, so that a text beyond the bound stands alone
                    break
                ahead = None
                held.append(own)
                size += len(own)
                j += 1
            if len(held) == 1 and size > self.most // 2:
                n, best = self.most // 2 // STRIDE * STRIDE, -np.inf
                for a in range(0, max(1, size - WINDOW + STRIDE), n):
                    best = max(best, self._best([held[0][a : a + n + WINDOW - STRIDE]])[0])
                yield i, [best]
            else:
                yield i, self._best(held)
            i = j

    def _best(self, texts: list[list[str]]) -> np.ndarray:
        new = list(set().union(*texts).difference(self.number))
        if len(self.number) + len(new) > self.most:
            self.number.clear()
            new = list(set().union(*texts))
        self._learn(new)
        numbers = [np.fromiter(map(self.number.__getitem__, t), np.int64, len(t)) for t in texts]
        sizes = np.array([max(WINDOW, len(t)) for t in texts])
        flat = np.zeros(int(sizes.sum()) + WINDOW, np.int64)
        firsts = np.cumsum(sizes) - sizes
        starts, owner = [], []
        for k, (t, first) in enumerate(zip(numbers, firsts.tolist())):
            flat[first : first + len(t)] = t
            own = window_starts(len(t))
            starts += [first + s for s in own]
            owner += [k] * len(own)
        rows = flat[np.array(starts)[:, None] + np.arange(WINDOW)]
        # a last window that is not full reads on into the next text: blank that
        rows[np.array(starts)[:, None] + np.arange(WINDOW) >= (firsts + sizes)[np.array(owner)][:, None]] = 0
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, np.array(owner), self.net.logits(self.x, rows))
        return best


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of the bounded sample of rows that may be learnt from."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    bounds = ((1, toxic_rows), (0, clean_rows))
    first = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in bounds]
    sample = F.broadcast(first[0].unionByName(first[1]))  # at most toxic_rows + clean_rows rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    # once more, for doc_ids may be repeated
    return bounded(rows, "toxic", bounds)


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on the sample's whole texts."""
    rows = sorted(training_rows(docs, labels).collect(), key=lambda r: (r.doc_id, r.toxic, r.text or ""))
    texts = []
    for r in rows:
        w = words(r.text)
        texts.append([w[s : s + WINDOW] for s in window_starts(len(w))])
    return train(texts, [r.toxic for r in rows])


def score(docs: DataFrame, net: Network, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each row's text as the column ``name`` (a double from 0 to 1)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    from tidemark.llm.common import chunks

    docs = docs.drop(name)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        scorer = Scorer(sent.value)
        for b in chunks(batches, at):
            got = scorer(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], schema=pa.schema([*b.schema, arrow.field(len(arrow) - 1)]))

    return map_arrow(docs, run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
