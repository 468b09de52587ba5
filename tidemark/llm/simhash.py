"""SimHash near-duplicates by a self-join over binary tries.

``fingerprints`` gives each text 64 bits: a bit is 1 if it is set in over half of the text's shingle
hashes. ``links`` finds all pairs of different fingerprints within a Hamming budget. Two fingerprints
with at most b differing bits agree on at least one of b + 1 blocks of bits, so each fingerprint goes
to b + 1 groups, and each group is joined with itself as a binary trie: node pairs are walked
together, differing bits add up along the path, and a pair whose sum exceeds the budget is dropped
with everything below it. A group returns the links of a spanning forest, never all its pairs. Groups
of over ``GROUP_ROWS`` fingerprints are divided once more, by the b + 1 blocks of their other bits, one
of which must agree too; what is still larger is joined piece by piece. Both are exact.
``components`` joins the forests to connected components by alternating star contractions.

Edge cases: a null or blank text has fingerprint 0, which links like any other; copies share a
fingerprint and so a component; a row without doc_id takes part with its text but is never a
component's id (all-null components have a null id); repeated rows are returned as often as they
come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, join_hot, map_arrow, map_rows, settled, small, table

QUERY = "op8_simhash_dedup"
WORDS = 4
BUDGET = 4
SEED = 42
#: Fingerprints joined in one piece; more are joined piece by piece.
GROUP_ROWS = 50_000
#: Node pairs with at most this many leaf pairs are compared at once, and node pairs held at a time.
LEAF_PAIRS, FRONTIER = 256, 500_000


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer."""
    import xxhash

    got = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not got:
        return 0
    line = b" ".join(got)
    ends = list(accumulate(map(len, got), lambda a, n: a + n + 1, initial=0))
    count = max(1, len(got) - words + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65536):
        upto = min(count, at + 65536)
        h = np.fromiter((digest(line[a : b - 1], seed) for a, b in zip(ends[at:upto], ends[at + min(words, len(got)) :])), np.uint64, upto - at)
        ones += ones_by_bit(h)
    return majority(ones, count)


def ones_by_bit(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, the highest first."""
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)


def majority(ones: np.ndarray, count: int) -> int:
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def batch(b):
        fps = np.array([fingerprint(t, words, seed) for t in b.column(1).to_pylist()], np.uint64)
        return {"doc_id": b.column(0), "fp": pa.array(fps.view(np.int64))}

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), batch, "doc_id long, fp long")


def trie_pairs(group: np.ndarray, fps: np.ndarray, budget: int, keep) -> None:
    """Call ``keep(i, j)`` with arrays of positions of linked fingerprints, of each group with itself.

    The rows are sorted by group, then fingerprint (unsigned). A trie node is a run of rows; its
    children are the rows with a 0 and with a 1 in the next bit.
    """
    if not len(fps):
        return
    ones = np.zeros((65, len(fps) + 1), np.int32)
    for bit in range(64):
        ones[bit, 1:] = np.cumsum((fps >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int32)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], len(fps)]
    zero = np.zeros(len(starts), np.int64)
    work = [(0, np.stack([starts, ends, starts, ends, zero]))]
    while work:
        bit, nodes = work.pop()
        alo, ahi, blo, bhi, err = nodes
        small = ((ahi - alo) * (bhi - blo) <= LEAF_PAIRS) | (bit >= 64)
        if small.any():
            _leaves(nodes[:, small], fps, budget, keep)
        nodes = nodes[:, ~small]
        if not nodes.shape[1]:
            continue
        if nodes.shape[1] > FRONTIER:
            work += [(bit, part) for part in np.array_split(nodes, -(-nodes.shape[1] // FRONTIER), axis=1)]
            continue
        alo, ahi, blo, bhi, err = nodes
        amid = ahi - (ones[bit, ahi] - ones[bit, alo])
        bmid = bhi - (ones[bit, bhi] - ones[bit, blo])
        same = alo == blo
        below = np.concatenate(
            [
                np.stack([alo, amid, blo, bmid, err]),
                np.stack([amid, ahi, bmid, bhi, err]),
                np.stack([alo, amid, bmid, bhi, err + 1]),
                np.stack([amid, ahi, blo, bmid, err + 1])[:, ~same],
            ],
            axis=1,
        )
        work.append((bit + 1, below[:, (below[0] < below[1]) & (below[2] < below[3]) & (below[4] <= budget)]))


def _leaves(nodes: np.ndarray, fps: np.ndarray, budget: int, keep) -> None:
    for part in np.array_split(nodes, -(-nodes.shape[1] * LEAF_PAIRS // 8_000_000) or 1, axis=1):
        alo, ahi, blo, bhi, _ = part
        sizes = (ahi - alo) * (bhi - blo)
        at = np.repeat(np.arange(len(sizes)), sizes)
        k = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = (bhi - blo)[at]
        i, j = alo[at] + k // width, blo[at] + k % width
        fine = (i < j) & (np.bitwise_count(fps[i] ^ fps[j]) <= budget)
        if fine.any():
            keep(i[fine], j[fine])


class Forest:
    """Union-find over positions that remembers the links which joined two trees."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def flatten(self) -> None:
        while (to := self.root[self.root]).tobytes() != self.root.tobytes():
            self.root = to

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.flatten()
        a, b = self.root[i], self.root[j]
        new = a != b
        if not new.any():
            return
        i, j, a, b = i[new], j[new], np.minimum(a[new], b[new]), np.maximum(a[new], b[new])
        _, first = np.unique(a * len(self.root) + b, return_index=True)
        for x, y in zip(i[first].tolist(), j[first].tolist()):
            a, b = self.find(x), self.find(y)
            if a != b:
                self.root[max(a, b)] = min(a, b)
                self.links.append((x, y))


def _join_groups(budget: int):
    """mapInArrow function over rows (key, sub, i, j, fp) sorted by group: the links of each group's forest."""

    def links(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        forest = Forest(len(fps))
        trie_pairs(key, fps, budget, forest.add)
        x = np.array(forest.links, np.int64).reshape(-1, 2)
        signed = fps.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[x[:, 0]]), pa.array(signed[x[:, 1]])], names=["u", "v"])

    def run(batches):
        held_key, held_fp = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
        for b in batches:
            key = np.stack([b.column(c).to_numpy() for c in range(4)], 1).astype(np.int64)
            held_key = np.concatenate([held_key, key])
            held_fp = np.concatenate([held_fp, b.column(4).to_numpy().view(np.uint64)])
            if len(held_key) < GROUP_ROWS:
                continue
            last = (held_key != held_key[-1]).any(1).nonzero()[0]
            if len(last):  # all but the group that may go on
                cut = last[-1] + 1
                yield links(*_sorted(held_key[:cut], held_fp[:cut]))
                held_key, held_fp = held_key[cut:], held_fp[cut:]
        if len(held_key):
            yield links(*_sorted(held_key, held_fp))

    return run


def _sorted(key: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    group = np.cumsum(np.r_[True, (key[1:] != key[:-1]).any(1)])
    order = np.lexsort((fps, group))
    return group[order], fps[order]


def _blocks(budget: int, bits: list[int]) -> list[list[int]]:
    """The bits (0 the lowest) in budget + 1 blocks."""
    cuts = [round(len(bits) * k / (budget + 1)) for k in range(budget + 2)]
    return [bits[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


def _block_value(block: list[int]) -> Column:
    """The bits of ``fp`` in a block, as a number; a block is one run of bits or two."""
    runs = np.split(np.array(block), np.flatnonzero(np.diff(block) != 1) + 1)
    out, at = F.lit(0).cast("long"), 0
    for r in runs:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", int(r[0])).bitwiseAND(F.lit((1 << len(r)) - 1).cast("long")), at))
        at += len(r)
    return out


def links(fps: DataFrame, budget: int = BUDGET, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (u, v) between different values of ``fp`` that leave its Hamming graph's components as they are."""
    blocks = _blocks(budget, list(range(64)))
    tagged = lambda k, c: F.lit(k).cast("long") * F.lit(1 << 48) + c
    keys = F.array(*[tagged(k, _block_value(b)) for k, b in enumerate(blocks)])
    rows = fps.select("fp").distinct().select("fp", F.explode(keys).alias("key"))
    # at most (budget + 1) * 2**(64 / (budget + 1)) groups, and only the large ones of them
    large = rows.groupBy("key").count().where(F.col("count") > group_rows).select("key", F.lit(True).alias("large"))
    marked = rows.join(F.broadcast(large), "key", "left")
    within = F.lit(None).cast("array<long>")
    for k, b in enumerate(blocks):
        others = [bit for bit in range(64) if bit not in b]
        subs = F.array(*[tagged(j, _block_value(x)) for j, x in enumerate(_blocks(budget, others))])
        within = F.when(F.shiftright("key", 48) == k, subs).otherwise(within)
    dealt = marked.select("key", "fp", F.explode(F.when(F.col("large"), within).otherwise(F.array(F.lit(-1).cast("long")))).alias("sub"))
    # of the second division's groups those that are still too large: as many as fit in group_rows times the rows
    hot = dealt.where("sub >= 0").groupBy("key", "sub").count().where(F.col("count") > group_rows).select("key", "sub", F.ceil(F.col("count") / group_rows).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    dealt = (
        dealt.join(small(checkpoint(hot)), ["key", "sub"], "left")
        .select("key", "sub", "fp", F.coalesce("pieces", F.lit(1)).alias("pieces"))
        .select("key", "sub", "fp", piece.alias("own"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
        .select("key", "sub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    grouped = dealt.repartition("key", "sub", "i", "j").sortWithinPartitions("key", "sub", "i", "j")
    return map_arrow(grouped, _join_groups(budget), "u long, v long").distinct()


def stars(edges: DataFrame) -> bool:
    """Whether the different links (u, v), u > v, are stars around their v: no node has two links down, or one down and one up."""
    ends = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where(F.col("down") + F.col("up") > 1).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (u, v): root is the smallest node of the connected component.

    Alternating large and small stars; each round's links are written, and rounds end once the links are stars.
    """
    edges = settled(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpoint(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")))
        large = join_hot(both, least, "u", "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        large = checkpoint(large)
        least = checkpoint(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        lesser = join_hot(large, least, "u", "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settled(lesser.unionByName(least.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, fp, component_id) for each row; component_id is the smallest doc_id that links reach."""
    fps = checkpoint(fingerprints(docs, id_col, text_col, words))
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("rows"))
    roots = components(links(fps, budget))
    member = checkpoint(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", "rows", F.coalesce("root", "fp").alias("root")))
    ids = checkpoint(member.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n")))
    named = checkpoint(join_hot(member, ids, "root", "n").select("fp", "component_id", "rows"))
    return join_hot(fps, named, "fp", "rows").select("doc_id", "fp", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
