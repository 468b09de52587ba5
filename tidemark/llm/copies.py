"""Near copies by an exact join of shingle sets.

Two texts are near copies if the sets of their ``WORDS``-word shingles have a Jaccard similarity of at
least ``SIMILAR``. A set of n shingles then shares at least SIMILAR * n of them with the other, so in any
common order of shingles the first n - ceil(SIMILAR * n) + 1 of both have one in common: texts are joined
on these, where they stand early enough in both for the rest to be as much as a similar pair has in common. No pair is missed. The order is by hash with frequent shingles last; which are frequent is read
off a sample, which bears on cost only. Texts that share one frequent shingle are compared part by part, and most are told
apart by a short sketch of their sets before a pair is written.

Candidates come in two rounds, so that large groups of near copies don't cost all their pairs: first the
links of the texts' SimHash fingerprints, found by the trie join of ``simhash``, and each text with one
text of its group; then all pairs that are not yet in one component. A pair is ruled out if the parities
of its sets in some cells of a hash differ in more cells than the sets may differ in members; sets have
cells in proportion to their size. What is left is compared in full. The pairs of the second round are not
written, as a group has their square many: a task tells only which sets hang together by them, those come to one
task with all their shingles, each once, and it tells fewer links than it has sets.

Words are cut at ASCII blanks and compared with A-Z in lower case, as by ``simhash.fingerprint``; a text of
fewer words is one shingle; null and blank texts are copies of each other and of nothing else.
"""

from __future__ import annotations

import math
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Cache, checkpoint, join_hot, map_arrow, map_rows, released, small
from tidemark.llm.simhash import BUDGET, components, links, majority, ones_by_bit

WORDS, SIMILAR = 5, 0.8
#: The share of both sizes that similar sets differ in at most.
APART = (1 - SIMILAR) / (1 + SIMILAR) + 1e-9
#: Cells of a set's parities: a power of two, at least so many and at least twice the set's size.
PARITIES = 512
#: Cells of the parities that go with each first shingle, two longs (a larger set's have a cell for each member besides), and
#: rows of one shingle that meet in a task.
SKETCH, GROUP_ROWS = 128, 8192
#: Shingles of a part of sets that are compared in full, for each row of GROUP_ROWS.
ROW_SHINGLES = 128
#: One document in SAMPLE tells which shingles are frequent: those in at least FREQUENT of them, MOST_FREQUENT at most.
SAMPLE, FREQUENT, MOST_FREQUENT = 16, 4, 200_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of a row's id and text; null and empty differ."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def word_hashes() -> Cache:
    import xxhash

    return Cache(xxhash.xxh64_intdigest)


def shingles(text: str | None, hashes: Cache) -> np.ndarray:
    """The sorted hashes of a text's different shingles."""
    got = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not got:
        return np.zeros(0, np.uint64)
    h = np.fromiter((hashes[w] for w in got), np.uint64, len(got))
    width, count = min(WORDS, len(h)), max(1, len(h) - WORDS + 1)
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out += (h[k : k + count] ^ (h[k : k + count] >> np.uint64(29))) * _FACTORS[k]
    out = (out ^ (out >> np.uint64(32))) * _FACTORS[0]
    return np.unique(out ^ (out >> np.uint64(29)))


def needed(n: int) -> int:
    """The least overlap of a set of n with any set as similar as SIMILAR."""
    return math.ceil(SIMILAR * n - 1e-9)


def _sets(rows: DataFrame) -> DataFrame:
    """(t, s) of rows (t, text): s is the array of the text's shingles."""

    def batch(b):
        hashes = word_hashes()
        return {"t": b.column(0), "s": pa.array([shingles(t, hashes).view(np.int64) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))}

    return map_rows(rows, batch, "t long, s array<long>")


def _frequent(docs: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    sample = docs.where(F.pmod(F.xxhash64(F.lit(3), id_col, F.length(text_col)), F.lit(SAMPLE)) == 0).select(F.lit(0).cast("long").alias("t"), F.col(text_col).alias("text"))
    counts = _sets(sample).select(F.explode("s").alias("h")).groupBy("h").count().where(F.col("count") >= FREQUENT)
    top = counts.orderBy(F.desc("count"), "h").limit(MOST_FREQUENT).select("h").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def parities(s: np.ndarray) -> np.ndarray:
    """For each cell whether an odd number of the shingles falls into it, packed into longs."""
    cells = max(PARITIES, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((s % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(x: Column, size: Column) -> Column:
    """Parities in fewer cells, ``size`` longs: what falls into one cell there falls into these here."""
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.aggregate(F.sequence(F.lit(0), (F.size(x) / size).cast("int") - 1), F.lit(0).cast("long"), lambda s, j: s.bitwiseXOR(F.get(x, i + j * size))))


def sketch(x: np.ndarray, n: int) -> np.ndarray:
    """The parities ``x`` of a set of n in a power of two of cells, at least n; none of a set for which SKETCH cells do."""
    return np.bitwise_xor.reduce(x.reshape(-1, (1 << (n - 1).bit_length()) // 64)) if n > SKETCH else x[:0]


def prefixes(docs: DataFrame, id_col: str, text_col: str, frequent: np.ndarray) -> DataFrame:
    """(k, doc_id, t, n, fp, p, x, y, z, w): the row's key, a hash of its shingle set, the set's size, fingerprint, first shingles,
    parities, these in SKETCH cells, and a larger set's ``sketch``."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def batch(b):
        import xxhash

        hashes, late = word_hashes(), sent.value
        t, n, fp, p, x = [], [], [], [], []
        for text in b.column(1).to_pylist():
            s = shingles(text, hashes)
            t.append(xxhash.xxh64_intdigest(s.tobytes()))
            n.append(len(s))
            fp.append(majority(sum(ones_by_bit(s[a : a + 65536]) for a in range(0, len(s), 65536)), len(s)) if len(s) else 0)
            x.append(parities(s))
            if len(late):
                common = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                s = np.concatenate([s[~common], s[common]])
            p.append(s[: len(s) - needed(len(s)) + 1].view(np.int64))
        brief = np.array([np.bitwise_xor.reduce(c.reshape(-1, SKETCH // 64)) for c in x], np.int64).reshape(-1, SKETCH // 64)
        return {"k": b.column(2), "doc_id": b.column(0), "t": pa.array(np.array(t, np.uint64).view(np.int64)), "n": n, "fp": pa.array(np.array(fp, np.uint64).view(np.int64)), "p": pa.array(p, pa.list_(pa.int64())), "x": pa.array(x, pa.list_(pa.int64())), "y": brief[:, 0], "z": brief[:, 1], "w": pa.array(list(map(sketch, x, n)), pa.list_(pa.int64()))}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("k"))
    return map_rows(rows, batch, "k long, doc_id long, t long, n int, fp long, p array<long>, x array<long>, y long, z long, w array<long>")


def _groups(batches):
    """Arrays of the columns but the first of each group of two or more rows that agree in the first; the rows come sorted by it."""
    held = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(c).to_numpy().astype(np.int64) for c in range(b.num_columns)])
        if held and held[0][0, 0] == cols[0, -1]:
            held.append(cols)
            continue
        cut = np.searchsorted(cols[0], cols[0, -1])
        yield from _cut(np.concatenate([*held, cols[:, :cut]], axis=1))
        held = [cols[:, cut:]]
    if held:
        yield from _cut(np.concatenate(held, axis=1))


def _cut(cols: np.ndarray):
    starts = np.flatnonzero(np.diff(cols[0], prepend=cols[0, :1] - 1))
    ends = np.r_[starts[1:], cols.shape[1]]
    for a, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        yield cols[1:, a:e]


def _batches(found, names: list[str], most: int = 100_000):
    parts, size = [], 0
    for part in found:
        parts.append(part)
        size += part.shape[1]
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(parts, axis=1)], names=names)
            parts, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(parts, axis=1)], names=names)


def _shared(group_rows: int):
    """mapInArrow function from rows (h, t, n, i) sorted by h to those that several sets have, with the group's first set as c, cn and the row's part.

    A part is group_rows rows of a group. Rows go on as they come; of a group only its first set and its size are held.
    """
    names = ["h", "t", "n", "i", "c", "cn", "part"]

    def run(batches):
        alone, known = None, None  # the last group's only row so far, or (h, c, cn, rows) of one that has more
        for b in batches:
            if not b.num_rows:
                continue
            cols = np.stack([b.column(c).to_numpy().astype(np.int64) for c in range(4)])
            if alone is not None:
                cols = np.concatenate([alone, cols], axis=1)
            starts = np.flatnonzero(np.r_[True, cols[0, 1:] != cols[0, :-1]])
            sizes = np.diff(np.r_[starts, cols.shape[1]])
            at = np.arange(cols.shape[1]) - np.repeat(starts, sizes)
            middle, several = np.repeat(cols[1:3, starts], sizes, axis=1), np.repeat(sizes > 1, sizes)
            if known is not None and known[0] == cols[0, 0]:
                own = slice(0, sizes[0])
                middle[:, own], several[own] = np.array(known[1:3])[:, None], True
                at[own] += known[3]
            alone, known = (None, (cols[0, -1], *middle[:, -1], at[-1] + 1)) if several[-1] else (cols[:, -1:], None)
            out = np.concatenate([cols, middle, at[None] // group_rows])[:, several]
            if out.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)

    return run


def dealt(shared: DataFrame, marks: DataFrame) -> DataFrame:
    """(g, t, n, i, root, y, z, side, x) of shared first shingles and of marks (t, root, y, z, x): the rows that are compared meet in one g.

    A group of several parts meets part by part: g for each two of them, in which only rows of different ``side`` are
    compared, and for each part itself, whose rows have side 0. So no task holds more than two parts of a group.
    """
    parts = small(checkpoint(shared.where("part > 0").groupBy("h").agg(F.max("part").alias("parts"))))
    rows = shared.select("h", "t", "n", "i", "part").join(marks, "t").join(parts, "h", "left")
    others = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts")))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    g = F.when(F.col("parts").isNull(), F.col("h")).otherwise(F.xxhash64("h", low, high))
    side = F.when(low == high, 0).when(F.col("part") == low, 1).otherwise(2).cast("long")
    return rows.withColumn("other", F.explode(others)).select(g.alias("g"), "t", "n", "i", "root", "y", "z", side.alias("side"), "x")


def _numbered(batches, held: list):
    """The batches with the running number of each row in place of its sketch; the sketches go to ``held``."""
    at = 0
    for b in batches:
        if b.num_columns == 8:
            yield b
            continue
        flat, ends = b.column(8).flatten().to_numpy().view(np.uint64), b.column(8).offsets.to_numpy()
        ends = (ends - ends[0]).tolist()
        held.extend(map(flat.__getitem__, map(slice, ends[:-1], ends[1:])))
        yield pa.RecordBatch.from_arrays([*b.columns[:8], pa.array(np.arange(at, at + b.num_rows))], names=b.schema.names)
        at += b.num_rows


class _Sketches:
    """The sketches of a group's rows, which come by size: ``differ(k, j)`` counts the cells in which those of rows j differ from k's.

    The sketch of a row after k has as many cells as k's or twice as many, if they may be similar, and is folded then. Rows without a sketch differ in none.
    """

    def __init__(self, x: list[np.ndarray]):
        self.longs, self.at = np.array([len(c) for c in x]), np.zeros(len(x), np.int64)
        self.own, self.half = {}, {}
        for size in np.unique(self.longs[self.longs > 0]).tolist():
            rows = np.flatnonzero(self.longs == size)
            self.at[rows] = np.arange(len(rows))
            self.own[size] = np.stack([x[r] for r in rows])
            self.half[size // 2] = self.own[size][:, : size // 2] ^ self.own[size][:, size // 2 :]

    def differ(self, k: int, j: np.ndarray) -> np.ndarray:
        out, size = np.zeros(len(j), np.int64), int(self.longs[k])
        if size:
            mine = self.own[size][self.at[k]]
            for others, longs in ((self.own, size), (self.half, 2 * size)):
                some = np.flatnonzero(self.longs[j] == longs)
                if len(some):
                    out[some] = np.bitwise_count(others[size][self.at[j[some]]] ^ mine).sum(1, dtype=np.int64)
        return out


def _candidates(batches):
    """(t, k, j) by rows k of one g: the places j after k of rows of other roots, sizes, places and sketches that may be similar; t are the
    rows of g by size.

    ``i`` is the place of the shingle in the set's order. Of a similar pair's first common shingle that is early: what both have
    in common comes at it or later in both, and is at least SIMILAR / (1 + SIMILAR) of their sizes together. So sets in which a
    frequent shingle stands late make no pairs by it. ``y`` and ``z`` are the sets' parities in SKETCH cells, of which no more may
    differ than members: this rules out small sets that have only a frequent passage in common before a pair is made. ``x``, if it
    is there, has the larger sets' parities in as many cells as they need for that.
    """
    share = SIMILAR / (1 + SIMILAR) - 1e-9
    held, gone = [], 0
    for t, n, i, root, y, z, side, *number in _groups(_numbered(batches, held)):
        order = np.argsort(n, kind="stable")
        sketches = _Sketches([held[r - gone] for r in number[0][order].tolist()]) if number else None
        if number:  # what comes before the next group is not asked for again
            last = int(number[0][-1]) + 1
            del held[: last - gone]
            gone = last
        t, n, i, root, y, z, side = (c[order] for c in (t, n, i, root, y, z, side))
        y, z = y.view(np.uint64), z.view(np.uint64)
        after = n - i
        upto = np.searchsorted(n, np.minimum(np.floor(n / SIMILAR + 1e-9), after / share - n), "right")
        # how large the other may be by what is after h in the larger one
        most = after / share - n
        for k in np.flatnonzero(upto > np.arange(len(t)) + 1).tolist():
            own = slice(k + 1, upto[k])
            j = np.flatnonzero((root[own] != root[k]) & (most[own] >= n[k]) & ((side[own] != side[k]) | (side[k] == 0))) + k + 1
            differ = np.bitwise_count(y[j] ^ y[k]).astype(np.int64) + np.bitwise_count(z[j] ^ z[k])
            j = j[differ <= APART * (n[j] + n[k])]
            if sketches and len(j):
                j = j[sketches.differ(k, j) <= APART * (n[j] + n[k])]
            if len(j):
                yield t, k, j


def _pairs(batches):
    """All pairs (u, v) that may be similar, as their square many."""
    found = (np.stack([np.minimum(t[k], t[j]), np.maximum(t[k], t[j])]) for t, k, j in _candidates(batches))
    yield from _batches(found, ["u", "v"])


def _chains(batches):
    """Links (u, v), fewer than rows, by which all rows of a g hang together that pairs that may be similar connect."""

    def run():
        of = None
        for t, k, j in _candidates(batches):
            if t is not of:
                of, label = t, np.arange(len(t))
            others, first = np.unique(label[j], return_index=True)
            first, others = first[others != label[k]], others[others != label[k]]
            if len(others):
                label[np.isin(label, others)] = label[k]
                yield np.stack([np.full(len(first), t[k]), t[j[first]]])

    yield from _batches(run(), ["u", "v"])


def _linked(batches):
    """Links (u, v), fewer than rows, between rows (g, t, root, side, s) of one g whose sets are as similar as SIMILAR: with the
    roots' they connect all such pairs of rows, of different sides if these are not 0.

    Pairs that are connected by then are not compared; the others are by size, by parities of their sets, and in full.
    """

    def rows():
        for b in batches:
            s = b.column(4)
            at, values = s.offsets.to_numpy() - s.offsets.to_numpy()[0], s.flatten().to_numpy()
            yield from zip(*(b.column(c).to_pylist() for c in range(4)), map(values.__getitem__, map(slice, at[:-1].tolist(), at[1:].tolist())))

    def run():
        for _, group in groupby(rows(), key=itemgetter(0)):
            group = sorted(group, key=lambda r: len(r[4]))
            sets = [r[4] for r in group]
            t, side, n = np.array([r[1] for r in group]), np.array([r[3] for r in group]), np.array([len(s) for s in sets])
            label = np.unique([r[2] for r in group], return_inverse=True)[1]
            odd = np.stack([np.packbits(np.bincount((s.view(np.uint64) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES).astype(np.uint8) & 1).view(np.uint64) for s in sets])
            upto = np.searchsorted(n, np.floor(n / SIMILAR + 1e-9), "right")
            flat, begin = np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(n) - n
            mark = np.zeros(len(flat) + 1, bool)
            for k in range(len(group)):
                own = slice(k + 1, upto[k])
                j = np.flatnonzero((label[own] != label[k]) & ((side[own] != side[k]) | (side[k] == 0))) + k + 1
                for c in range(2):  # a part of the cells tells most pairs apart
                    cells = slice(0, 2) if c == 0 else slice(2, None)
                    differ = np.bitwise_count(odd[j, cells] ^ odd[k, cells]).sum(1, dtype=np.int64) + (differ if c else 0)
                    near = differ <= APART * (n[j] + n[k])
                    j, differ = j[near], differ[near]
                if not (len(j) and n[k]):
                    continue
                mine, ends = flat[begin[k] : begin[k] + n[k]], np.cumsum(n[j])
                mark[mine] = True
                at = np.repeat(begin[j] - ends + n[j], n[j]) + np.arange(ends[-1])
                both = np.add.reduceat(mark[flat[at]], ends - n[j], dtype=np.int64)
                mark[mine] = False
                for m in j[both >= (SIMILAR - 1e-12) * (n[k] + n[j] - both)].tolist():
                    if label[m] != label[k]:
                        label[label == label[m]] = label[k]
                        yield np.array([[t[k]], [t[m]]])

    yield from _batches(run(), ["u", "v"])


def linked(chains: DataFrame, sets: DataFrame, marks: DataFrame, docs: DataFrame, part_shingles: int) -> DataFrame:
    """Links (u, v) between similar sets of different roots: with the roots' they connect all such pairs that ``chains`` (u, v) connect.

    Sets that chains connect meet in one task, each once; larger groups of them by parts of about ``part_shingles`` shingles, every two.
    """
    nodes = checkpoint(components(chains).toDF("t", "group"))
    groups = checkpoint(nodes.unionByName(nodes.select(F.col("group").alias("t"), "group").distinct()))
    sizes = groups.join(sets.select("t", "n"), "t").groupBy("group").agg((F.sum("n") / part_shingles).cast("long").alias("last"))
    large = small(checkpoint(sizes.where("last > 0")))
    own = docs.join(small(checkpoint(sets.select("t", "k").join(groups, "t", "left_semi"))), "k").select("t", "text")
    shingled = _sets(checkpoint(own.dropDuplicates(["t"])))
    rows = shingled.join(groups, "t").join(marks.select("t", "root"), "t").join(large, "group", "left").withColumn("last", F.coalesce("last", F.lit(0)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("t"), F.col("last") + 1)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    g = F.when(F.col("last") == 0, F.col("group")).otherwise(F.xxhash64("group", low, high))
    side = F.when(low == high, 0).when(F.col("part") == low, 1).otherwise(2).cast("long")
    dealt_rows = rows.select(g.alias("g"), "t", "root", side.alias("side"), "s").repartition("g").sortWithinPartitions("g")
    return checkpoint(map_arrow(dealt_rows, _linked, "u long, v long"))


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sizes and parities leave them possible."""
    own = small(checkpoint(pairs.select(F.explode(F.array("u", "v")).alias("t")).distinct()))
    side = checkpoint(sets.select("t", "n", "x").join(own, "t", "left_semi"))
    joined = pairs.join(side.toDF("u", "m", "a"), "u").join(side.toDF("v", "n", "b"), "v")
    joined = joined.where(F.greatest("m", "n") * F.lit(SIMILAR - 1e-12) <= F.least("m", "n"))
    size = F.least(F.size("a"), F.size("b"))
    fold = lambda c: F.when(F.size(c) > size, folded(F.col(c), size)).otherwise(F.col(c))
    differ = F.aggregate(F.zip_with(fold("a"), fold("b"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, c: s + c)
    return joined.where(differ <= F.lit(APART) * (F.col("m") + F.col("n"))).select("u", "v")


def similar(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are as similar as SIMILAR; docs has (k, text), sets the key k of one row of each set."""
    pairs = checkpoint(possible(checkpoint(pairs.distinct()), sets))
    either = small(checkpoint(pairs.select(F.explode(F.array("u", "v")).alias("t")).distinct()))
    some = small(checkpoint(sets.select("t", "k").join(either, "t", "left_semi")))
    own = checkpoint(_sets(docs.join(some, "k").select("t", "text")).dropDuplicates(["t"]))
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(own.toDF("u", "a"), "u").join(own.toDF("v", "b"), "v")
    return checkpoint(joined.where(both >= F.lit(SIMILAR - 1e-12) * (F.size("a") + F.size("b") - both)).select("u", "v"))


def _by_fingerprint(sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of sets whose fingerprints are equal or linked: each with the least set of its own, and these."""
    least = sets.groupBy("fp").agg(F.min("t").alias("t0"))
    equal = sets.select("fp", "t").join(least, "fp").select(F.col("t0").alias("u"), F.col("t").alias("v"))
    near = links(sets, BUDGET).join(least.toDF("u", "tu"), "u").join(least.toDF("v", "tv"), "v").select(F.col("tu").alias("u"), F.col("tv").alias("v"))
    return equal.unionByName(near).where("u <> v")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(k, doc_id, root) for each row: its key, its id and its component of near copies."""
    rows = checkpoint(prefixes(docs, id_col, text_col, _frequent(docs, id_col, text_col)))
    texts = docs.select(row_key(id_col, text_col).alias("k"), F.col(text_col).alias("text"))
    # copies count once from here
    counted = checkpoint(rows.groupBy("t").agg(F.min("k").alias("k"), F.count("*").alias("copies")))
    # of each set one row, and repeated rows have both in common: what is dealt for the join is not dealt again
    sets = checkpoint(rows.drop("doc_id").join(counted.select("t", "k"), ["t", "k"], "left_semi").dropDuplicates(["t", "k"]))
    released(docs.sparkSession)
    firsts = sets.select(F.posexplode("p").alias("i", "h"), "t", "n").select("h", "t", "n", "i")
    sort = lambda df, *keys: df.repartition(keys[0]).sortWithinPartitions(*keys)
    shared = checkpoint(map_arrow(sort(firsts, "h", "t"), _shared(group_rows), "h long, t long, n long, i long, c long, cn long, part long"))
    close = F.greatest("n", "cn") * F.lit(SIMILAR - 1e-12) <= F.least("n", "cn")
    star = shared.where(close & (F.col("t") != F.col("c"))).select(F.col("t").alias("u"), F.col("c").alias("v"))
    both = star.unionByName(_by_fingerprint(sets)).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    released(docs.sparkSession)
    first = similar(both, sets, texts)
    roots = components(first)
    marks = sets.select("t", "y", "z", "w").join(roots.withColumnRenamed("node", "t"), "t", "left").select("t", F.coalesce("root", "t").alias("root"), "y", "z", F.col("w").alias("x"))
    released(docs.sparkSession)
    chains = checkpoint(map_arrow(sort(dealt(shared, marks), "g"), _chains, "u long, v long").distinct())
    released(docs.sparkSession)
    found = roots.toDF("u", "v").unionByName(linked(chains, sets, marks, texts, group_rows * ROW_SHINGLES))
    final = components(found).withColumnRenamed("node", "t")
    named = checkpoint(counted.join(final, "t", "left").select("t", "copies", F.coalesce("root", "t").alias("root")))
    return join_hot(rows.select("k", "doc_id", "t"), named, "t", "copies").select("k", "doc_id", "root")
