"""Removal of long repeated byte strings, whole texts against each other, by bounded interval expansion on a Burrows-Wheeler transform.

A byte of a document goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.
``prefixes`` tells equal strings in a set of strings: suffixes are sorted by more than LENGTH symbols and the transform is
taken; from the empty string on, each interval of suffixes that begin with some string is extended backwards by each symbol
before it, breadth first, so boundaries between intervals appear by increasing common prefix. A new interval that begins
where a shorter one does gives nothing new, so only fresh boundaries are followed; after LENGTH rounds it stops, and
suffixes without a boundary between them agree in LENGTH bytes or more.

No task sees all texts. A string of LENGTH bytes is kept with its anchor, the place of its least hash of ``SEED``
bytes; equal strings have equal anchors, so it is enough to bring together what surrounds one anchor. Texts are packed into
blocks, whose anchors are counted over all blocks first; anchors of a single document are done with. Each block sends the
stretches around the others, each once with its smallest document, to the bucket of the anchor's hash; a bucket takes
stretches that are the same from many blocks together, expands intervals over what is left, and tells each block from
where in a stretch which document has it first. An anchor with more than ``HOT`` stretches is sent string by string,
each to the bucket of its own hash, so that a passage in a third of all documents, whatever stands around it, is split.
A bucket with more than ``SYMBOLS`` is worked through by parts of the hash.

Edge cases: a null text is empty; texts under LENGTH bytes stay; a null id counts as greater than all others; rows with
the same id, and with none, are no reason to remove each other's bytes; overlapping repeats within a text are kept if
only that text has them; long texts are whole, a block of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, map_arrow, table

QUERY = "op13_suffix_dedup"
LENGTH, SEED = 50, 24
#: Bytes of text in a block, and on average behind the anchors of a bucket, for up to ``PER_SCALE`` bytes of text in all. A block
#: sends a row to each bucket: with more text both grow by its root, up to MOST_SCALE times, so that the rows grow as the text does.
BLOCK, BUCKET, PER_SCALE, MOST_SCALE = 2 << 20, 1 << 20, 64 << 20, 8.0
#: Bytes of text for a task that works on buckets.
TASK = 32 << 20
#: Stretches of an anchor from which it is sent string by string, and symbols that are sorted at once.
HOT, SYMBOLS = 4096, 500_000
#: Windows whose hashes are made at once.
PIECE = 1 << 16
LAST = (1 << 63) - 1
_BITS, _LOW = 21, np.uint64(31)
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _byte_values() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xABC98388FB8FAC03)
    return x ^ (x >> np.uint64(29))


_UP, _DOWN, _VALUES = _powers(_MULTIPLIER, PIECE + 2 * LENGTH), _powers(_INVERSE, PIECE + 2 * LENGTH), _byte_values()


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes; at most PIECE + 2 * LENGTH bytes at once."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _UP[: len(data)], out=sums[1:])
    x = (sums[size:] - sums[:-size]) * _DOWN[: len(data) - size + 1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, hash): runs of windows with one anchor, by the places where their first and last window begin.

    ``ends`` are where documents end; no window crosses them. Runs end at pieces, too.
    """
    wide, out = LENGTH - SEED + 1, []
    shift = np.uint64(PIECE.bit_length() + 1)
    for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        piece = data[at : at + PIECE + LENGTH - 1]
        hashes = _hashes(piece, SEED)
        low = ((hashes >> shift) << shift) | np.arange(len(hashes), dtype=np.uint64)
        step = 1
        while 2 * step <= wide:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        low = np.minimum(low[: len(low) - (wide - step)], low[wide - step :])
        place = (low & np.uint64((1 << int(shift)) - 1)).astype(np.int64)
        # windows that begin in one document and end in another are none
        inner = ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + len(piece))] - at
        owner = np.zeros(len(piece) + 1, np.int32)
        np.add.at(owner, inner, 1)
        owner = np.cumsum(owner[: len(piece)])
        whole = owner[: len(place)] == owner[LENGTH - 1 : LENGTH - 1 + len(place)]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1 : len(place)] != owner[: len(place) - 1])
        new &= whole
        stop = np.ones(len(place), bool)
        stop[:-1] = new[1:] | ~whole[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(stop & whole)
        out.append((first + at, last + at, hashes[place[first]]))
    first, last, least = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    # least hashes are small: mixed again, they spread over all buckets
    mixed = (least ^ (least >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return first, last, mixed ^ (mixed >> np.uint64(31))


def _ordered(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The order of pairs of numbers below 2 ** 21, or below the count of them where that is greater."""
    n = len(high)
    if n <= 1 << _BITS:
        packed = (high.astype(np.uint64) << np.uint64(2 * _BITS)) | (low.astype(np.uint64) << np.uint64(_BITS)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        return (packed & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    return np.lexsort((low, high))


def suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The order of all suffixes by at least their first ``depth`` symbols (0 to 256)."""
    n = len(symbols)
    ahead = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    high, low, size = ahead[:n] << 9 | ahead[1 : n + 1], ahead[2 : n + 2] << 9 | ahead[3 : n + 3], 4
    while True:
        order = _ordered(high, low)
        if size >= depth:
            return order
        new = np.ones(n, np.int64)
        new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
        rank = np.zeros(n + size, np.int64)
        rank[order] = np.cumsum(new)  # 1 on; past the end there is 0
        if rank[order[-1]] == n:
            return order
        high, low, size = rank[:n] - 1, rank[size:] - (rank[size:] > 0), 2 * size


def prefixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): suffixes of strings that end in 0, in order, and how many symbols each has in common with the one
    before it as far as that is under ``length``, else ``length``. Only symbols before the 0 count, but suffixes that
    are under ``length`` are told apart from others only."""
    n = len(symbols)
    order = suffixes(symbols, length)
    before = symbols[order - 1]  # the transform; what stands before the first suffix is the last 0
    packed = (before.astype(np.int64) << 40) | np.arange(n)
    packed.sort()
    column = packed & ((1 << 40) - 1)
    to, previous = np.empty(n, np.int32), np.full(n, -1, np.int32)
    to[column] = np.arange(n, dtype=np.int32)
    same = before[column[1:]] == before[column[:-1]]
    previous[column[1:][same]] = column[:-1][same]
    previous[before == 0] = n  # extensions by an end are not followed
    common = np.full(n + 1, length, np.int32)
    common[n] = 0
    edge = np.zeros(n + 1, bool)
    edge[n] = True
    fresh = np.sort(to[column[np.flatnonzero(np.concatenate([[True], ~same]))]])
    common[fresh], edge[fresh] = 0, True
    fresh = fresh[symbols[order[fresh]] > 0]
    places = np.arange(n, dtype=np.int32)
    for level in range(1, length):
        if not fresh.size:
            break
        edges = np.flatnonzero(edge).astype(np.int32)
        size = edges[np.searchsorted(edges, fresh) + 1] - fresh
        if (total := int(size.sum())) > n // 3:  # nearly all intervals are fresh: take them all
            at = places[previous < np.repeat(edges[:-1], np.diff(edges))]  # the interval of the 0s is the first
        else:
            at = np.repeat(fresh - (np.cumsum(size) - size).astype(np.int32), size) + places[:total]
            at = at[previous[at] < np.repeat(fresh, size)]
        found = to[at]  # each interval and symbol leads to a place of its own
        fresh = np.sort(found[~edge[found]])
        common[fresh], edge[fresh] = level, True
    return order, common[:n]


def first_owner(strings: list[bytes], owners: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(at, least): for each window of ``length`` bytes of each string the least owner of a string that holds it; ``at``
    has where each string's windows begin in ``least``, and their end."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(int(ends[-1]), np.int16)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
    order, common = prefixes(symbols, length)
    owner = np.repeat(np.arange(len(strings), dtype=np.int32), sizes + 1)
    whole = (np.repeat(ends - 1, sizes + 1) - np.arange(len(symbols))) >= length
    mine = np.where(whole[order], owners[owner[order]], LAST)
    edges = np.flatnonzero(common < length)
    least = np.empty(len(symbols), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(mine, edges), np.diff(np.append(edges, len(symbols))))
    return np.concatenate([[0], np.cumsum(sizes - length + 1)]), least[whole]


# Blocks: (block, n_bytes, ids, ends, data), the arrays as bytes, the data compressed.
_BLOCK = "block long, n_bytes long, ids binary, ends binary, data binary"


def _table(rows: list[tuple], names: str, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names.split())


def scale(total: int) -> float:
    """How many times larger than ``BLOCK`` and ``BUCKET`` blocks and buckets are for so many bytes of text."""
    return min(MOST_SCALE, max(1.0, math.sqrt(total / PER_SCALE)))


def bucket_count(total: int) -> int:
    """A power of two."""
    return 1 << int(total // (BUCKET * scale(total))).bit_length()


def blocks(docs: DataFrame, most: int = BLOCK) -> DataFrame:
    """Texts packed into blocks of about ``most`` bytes; a longer text stands alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, zstd = TaskContext.get().partitionId() << 32, pa.Codec("zstd")
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        ids, texts, size = [], [], 0

        def packed():
            nonlocal number, ids, texts, size
            data = b"".join(texts)
            row = (number, len(data), np.array(ids, np.int64).tobytes(), np.cumsum([len(t) for t in texts], dtype=np.int64).tobytes(), zstd.compress(data, asbytes=True))
            number, ids, texts, size = number + 1, [], [], 0
            return _table([row], "block n_bytes ids ends data", types)

        for b in batches:
            for i, text in zip(b.column(0), b.column(1)):
                text = text.as_py().encode("utf-8", "surrogatepass")
                if texts and size + len(text) > most:
                    yield packed()
                ids.append(i.as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield packed()

    return map_arrow(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), run, _BLOCK)


def _opened(n_bytes: int, ids: bytes, ends: bytes, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    return pa.Codec("zstd").decompress(data, n_bytes, asbytes=True) if n_bytes else b"", np.frombuffer(ids, np.int64), np.frombuffer(ends, np.int64)


def _packed(notes: np.ndarray, buckets: int) -> bytes:
    """Five bytes each: what of a hash comes after its bucket, and the note. Hashes that become equal cost time only."""
    short = ((notes << np.uint64(buckets.bit_length() - 1)) >> np.uint64(29) << np.uint64(5)) | (notes & _LOW)
    return short.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted keys by bucket: the bucket is the top of the key."""
    of = (keys >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64) if buckets > 1 else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
    yield from ((int(of[a]), slice(a, b)) for a, b in zip(at, [*at[1:], len(of)]))


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(notes, inverse): a block's hashes in order, each with a note in its low bits of how often it occurs (as a power of two)
    and if in several documents, and where each occurrence's is."""
    keys, inverse, count = np.unique(hashes | _LOW, return_inverse=True, return_counts=True)
    low, high = np.full(len(keys), LAST), np.zeros(len(keys), np.int64)
    np.minimum.at(low, inverse, owner)
    np.maximum.at(high, inverse, owner)
    note = np.minimum(np.log2(count).astype(np.uint64), np.uint64(15)) | np.where(low < high, np.uint64(16), np.uint64(0))
    return (keys & ~_LOW) | note, inverse


def _read(block: dict) -> tuple:
    data, ids, ends = _opened(*(block[k] for k in ("n_bytes", "ids", "ends", "data")))
    first, last, hashes = anchors(np.frombuffer(data, np.uint8), ends)
    owner = np.searchsorted(ends, first, "right")
    return data, ids, ends, first, last, hashes, owner


def _blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _anchor_rows(buckets: int):
    def run(batches):
        for block in _blocks_of(batches):
            *_, hashes, owner = _read(block)
            notes, _ = _distinct(hashes, owner)
            rows = [(bucket, block["block"], _packed(notes[s], buckets)) for bucket, s in _by_bucket(notes, buckets)]
            yield _table(rows, "bucket block notes", [pa.int64(), pa.int64(), pa.binary()])

    return run


def _in_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows by their first column, which comes in order."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, group in groupby(rows, key=lambda r: r[0]):
        yield key, list(group)


def _repeated_rows(batches: Iterable[pa.RecordBatch], hot_from: int) -> Iterator[pa.RecordBatch]:
    """For each block's anchors of a bucket: which of them are in another document, and of these, which are frequent."""
    for bucket, rows in _in_groups(batches):
        own = [_unpacked(r[2]) for r in rows]
        notes = np.concatenate(own)
        keys, inverse, count = np.unique(notes & ~_LOW, return_inverse=True, return_counts=True)
        several = np.zeros(len(keys), bool)
        several[inverse[(notes & np.uint64(16)) > 0]] = True
        times = np.bincount(inverse, np.exp2((notes & np.uint64(15)).astype(np.float64)), len(keys))
        several |= count > 1
        hot = several & (times > hot_from)
        at, out = 0, []
        for r, x in zip(rows, own):
            i = inverse[at : at + len(x)]
            at += len(x)
            if several[i].any():
                out.append((r[1], bucket, len(x), np.packbits(several[i]).tobytes(), np.packbits(hot[i]).tobytes() if hot[i].any() else None))
        if out:
            yield _table(out, "block bucket n several hot", [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])


def _stretches(block: dict, buckets: int) -> tuple:
    """(strings, keys, least, most, which, place, owner, opened): a block's stretches around repeated anchors, each once, with
    the key of its bucket and its least and greatest document, and for each occurrence its number, place and document."""
    data, ids, ends, first, last, hashes, owner = _read(block)
    notes, inverse = _distinct(hashes, ids[owner])
    several, hot = np.zeros(len(notes), bool), np.zeros(len(notes), bool)
    told = {r["bucket"]: r for r in block["replies"] or []}
    for bucket, s in _by_bucket(notes, buckets):
        if r := told.get(bucket):
            several[s] = np.unpackbits(np.frombuffer(r["several"], np.uint8), count=r["n"]).astype(bool)
            if r["hot"]:
                hot[s] = np.unpackbits(np.frombuffer(r["hot"], np.uint8), count=r["n"]).astype(bool)
    chosen = np.flatnonzero(several[inverse])
    apart = hot[inverse[chosen]]
    usual, frequent = chosen[~apart], chosen[apart]
    place, stop, keys, owners = first[usual], last[usual] + LENGTH, hashes[usual], owner[usual]
    if frequent.size:
        count = last[frequent] - first[frequent] + 1
        each = np.repeat(first[frequent] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        place, stop, owners = np.concatenate([place, each]), np.concatenate([stop, each + LENGTH]), np.concatenate([owners, np.repeat(owner[frequent], count)])
        keys = np.concatenate([keys, _window_hashes(np.frombuffer(data, np.uint8), each)])
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(data[a:b], len(number)) for a, b in zip(place.tolist(), stop.tolist())), np.int64, len(place))
    key = np.zeros(len(number), np.uint64)
    key[which] = keys
    least, most = np.full(len(number), LAST), np.full(len(number), -LAST - 1)
    np.minimum.at(least, which, ids[owners])
    np.maximum.at(most, which, ids[owners])
    return list(number), key, least, most, which, place, owners, (data, ids, ends)


def _planes(x: np.ndarray) -> bytes:
    """Longs with their first bytes first, then the second ones and so on, which compress better."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplaned(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _window_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the windows at ``places``."""
    sums, out = np.zeros(LENGTH, np.uint64), np.empty(len(places), np.uint64)
    for at in range(0, len(places), 1 << 14):
        windows = data[places[at : at + (1 << 14), None] + np.arange(LENGTH)]
        sums = (_VALUES[windows] * _UP[:LENGTH]).sum(1, dtype=np.uint64)
        sums = (sums ^ (sums >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out[at : at + (1 << 14)] = sums ^ (sums >> np.uint64(29))
    return out


def _stretch_rows(buckets: int):
    types = [*[pa.int64()] * 4, pa.binary()]

    def run(batches):
        zstd, below = pa.Codec("zstd", 1), np.uint64(64 - buckets.bit_length() + 1)
        for block in _blocks_of(batches):
            if not block["replies"]:
                continue
            strings, key, least, most, *_ = _stretches(block, buckets)
            order = np.argsort(key, kind="stable")
            rows = []
            for bucket, s in _by_bucket(key[order], buckets):
                own = order[s]
                part = [strings[i] for i in own.tolist()]
                sizes = np.fromiter(map(len, part), np.uint16, len(part))
                # of the key what divides a bucket
                part_of = ((key[own] << (np.uint64(64) - below)) >> np.uint64(48)).astype(np.uint16)
                packed = zstd.compress(b"".join([b"".join(part), sizes, part_of, _planes(least[own]), _planes(most[own] - least[own])]), asbytes=True)
                rows.append((bucket, block["block"], len(own), int(sizes.sum(dtype=np.int64)), packed))
            yield _table(rows, "bucket block n size packed", types)

    return run


def _owner_rows(batches: Iterable[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    """For each block of a bucket: (own, start, n, owner), runs of windows of its stretches, in the order sent, that a smaller
    document has first."""
    zstd = pa.Codec("zstd")
    for bucket, rows in _in_groups(batches):
        number: dict[bytes, int] = {}
        which, keys, least, sent = [], [], [], []
        for _, block, n, size, packed in rows:
            data = zstd.decompress(packed, size + 20 * n, asbytes=True)
            sizes, part_of = np.frombuffer(data, np.uint16, n, size), np.frombuffer(data, np.uint16, n, size + 2 * n)
            low, over = _unplaned(data[size + 4 * n : size + 12 * n]), _unplaned(data[size + 12 * n :])
            stop = np.cumsum(sizes, dtype=np.int64).tolist()
            which.append(np.fromiter((number.setdefault(data[a:b], len(number)) for a, b in zip([0, *stop], stop)), np.int64, n))
            keys.append(part_of)
            least.append(low)
            sent.append((block, low + over))
        strings, every = list(number), np.concatenate(which)
        key, owners = np.zeros(len(strings), np.uint16), np.full(len(strings), LAST)
        key[every] = np.concatenate(keys)
        np.minimum.at(owners, every, np.concatenate(least))
        # parts of the bucket by key, none of which is divided
        order = np.argsort(key, kind="stable")
        size = np.cumsum(np.fromiter((len(strings[i]) + 1 for i in order.tolist()), np.int64, len(order)))
        edges = np.flatnonzero(np.concatenate([[True], key[order[1:]] != key[order[:-1]]]))
        parts, start = [], 0
        for a, b in zip(edges, [*edges[1:], len(order)]):
            if a > start and size[b - 1] - (size[start - 1] if start else 0) > symbols:
                parts.append((start, a))
                start = a
        parts.append((start, len(order)))
        runs = []
        for a, b in parts:
            own = order[a:b]
            at, first = first_owner([strings[i] for i in own.tolist()], owners[own])
            head = np.zeros(len(first), bool)
            head[at[:-1]] = True
            new = head.copy()
            new[1:] |= first[1:] != first[:-1]
            where = np.flatnonzero(new)
            of = np.cumsum(head)[where] - 1
            runs.append((own[of], where - at[of], np.diff(np.append(where, len(first))), first[where]))
        of, start, n, first = (np.concatenate(x) for x in zip(*runs))
        order = np.argsort(of, kind="stable")
        of, start, n, first = of[order], start[order], n[order], first[order]
        begin = np.searchsorted(of, np.arange(len(strings) + 1))
        out = []
        for (block, most), w in zip(sent, which):
            count = begin[w + 1] - begin[w]
            run = np.repeat(begin[w] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            gone = first[run] < np.repeat(most, count)
            if gone.any():
                run, own = run[gone], np.repeat(np.arange(len(w), dtype=np.int32), count)[gone]
                out.append((block, bucket, own.tobytes(), start[run].astype(np.int32).tobytes(), n[run].astype(np.int32).tobytes(), first[run].tobytes()))
        if out:
            yield _table(out, "block bucket own start n owner", [pa.int64(), pa.int64(), *[pa.binary()] * 4])


def _kept_rows(buckets: int):
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for block in _blocks_of(batches):
            if not block["gone"]:
                data, ids, ends = _opened(*(block[k] for k in ("n_bytes", "ids", "ends", "data")))
                edge = np.zeros(len(data) + 1, np.int32)
            else:
                _, key, _, _, which, place, owners, (data, ids, ends) = _stretches(block, buckets)
                sent = np.argsort(key, kind="stable")
                begins = {bucket: s.start for bucket, s in _by_bucket(key[sent], buckets)}
                edge = np.zeros(len(data) + 1, np.int32)
                order = np.argsort(which, kind="stable")
                begin = np.searchsorted(which[order], np.arange(int(which.max()) + 2))
                for r in block["gone"]:
                    own, start, n = (np.frombuffer(r[k], np.int32).astype(np.int64) for k in ("own", "start", "n"))
                    own = sent[own + begins[r["bucket"]]]
                    first = np.frombuffer(r["owner"], np.int64)
                    count = begin[own + 1] - begin[own]
                    at = order[np.repeat(begin[own] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
                    start, n, first = (np.repeat(x, count) for x in (start, n, first))
                    later = first < ids[owners[at]]
                    gone = place[at[later]] + start[later]
                    np.add.at(edge, gone, 1)
                    np.add.at(edge, gone + n[later] - 1 + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            rows, start, size = [], 0, 0
            for i, end in zip(ids.tolist(), ends.tolist()):
                own = gone[start:end]
                turn = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                kept = np.frombuffer(data[start:end], np.uint8)[~own].tobytes() if turn.size else data[start:end]
                rows.append((None if i == LAST else i, end - start, [{"start": a, "stop": b} for a, b in turn.reshape(-1, 2).tolist()], kept))
                start = end
            yield _table(rows, "doc_id n_bytes removed kept", [pa.int64(), pa.int64(), spans, pa.binary()])

    return run


def remove_repeats(docs: DataFrame, hot: int = HOT, symbols: int = SYMBOLS) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): each row's removed stretches of bytes and what is left of its text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    own = checkpoint(blocks(docs, int(BLOCK * scale(total))))
    buckets = bucket_count(total)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // TASK))
    together = lambda df: df.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    noted = map_arrow(own, _anchor_rows(buckets), "bucket long, block long, notes binary")
    told = map_arrow(together(noted), lambda batches: _repeated_rows(batches, hot), "block long, bucket long, n long, several binary, hot binary")
    replies = told.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "several", "hot")).alias("replies"))
    # the blocks are dealt once, for this join and the last
    asked = own.join(replies, "block", "left")
    sent = map_arrow(asked, _stretch_rows(buckets), "bucket long, block long, n long, size long, packed binary")
    owned = map_arrow(together(sent), lambda batches: _owner_rows(batches, symbols), "block long, bucket long, own binary, start binary, n binary, owner binary")
    gone = owned.groupBy("block").agg(F.collect_list(F.struct("bucket", "own", "start", "n", "owner")).alias("gone"))
    return map_arrow(asked.join(gone, "block", "left"), _kept_rows(buckets), "doc_id long, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["stop"] - r["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
