"""Token-id files in Simple-8b, a word-aligned code.

A 64-bit word holds a 4-bit selector and 60 payload bits; the selector says how many ids of which
width share the payload. An id of over 60 bits is an escape: its word points into a list of raw
64-bit values. Ids are coded in blocks of ``BLOCK`` that start on a word, and the offset of each block
is stored, so all blocks of a file are coded and decoded side by side by array operations.

A file (``pack``) is self-contained: magic, counts, document ids and lengths, block offsets, words,
escapes, all little-endian. ``write`` puts files of whole documents, in ascending doc_id order, into
a Parquet table in the shared folder (part, seq, payload, n_ids): Spark commits the table as a whole,
so lost executors leave no torn files. ``read`` returns each document's ids' digest from the files.

Edge cases: a null or empty text is a document of the end id alone; a null doc_id sorts first and
stays null; repeated rows, and documents with equal ids, follow each other by text; an empty table
gives an empty file table; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Cache, map_arrow, map_rows, shared_path, table

QUERY = "op3_simple8b_tokens"
END_ID = 2
BLOCK = 1024
#: A file is closed once it holds this many ids.
FILE_IDS = 1 << 18
MAGIC = b"TMS8B001"
#: Ids a word and bits an id, by selector; selector 1 marks an escape.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block and the end, escapes) of unsigned 64-bit ids."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    # ranks: 0 for the id 0, then the first selector whose width holds the id; doubles round up to more bits at most
    bits = np.frexp(ids.astype(np.float64))[1]
    rank = np.append(0, np.searchsorted(WIDTHS[2:], np.arange(1, 66)) + 1).astype(np.int8)[bits]
    rows = -(-n // block)
    most = np.zeros((rows, block + int(COUNTS[0])), np.int8)  # what is past a block's end fits any selector
    full = n // block
    most[:full, :block] = rank[: full * block].reshape(full, block)
    most[full:, : n - full * block] = rank[full * block :]
    choice = np.full((rows, block), ESCAPE, np.int8)
    span = 1  # most holds the largest rank of so many ids from each on
    for s in range(15, -1, -1):  # ever more ids a word; the last that fits is the best
        if s == ESCAPE:
            continue
        count = int(COUNTS[s])
        while 2 * span <= count:
            most = np.maximum(most[:, :-span], most[:, span:])
            span *= 2
        largest = np.maximum(most[:, :block], most[:, count - span : count - span + block])
        np.copyto(choice, s, where=largest <= max(0, s - 1))
    choice = choice.ravel()[:n]
    at = np.arange(n)
    ends = np.minimum((at // block + 1) * block, n)
    left = ends - at
    step = np.minimum(COUNTS[choice], left)
    firsts = np.arange(0, n, block)
    pos, until, found = firsts.copy(), ends[firsts], []
    lane = np.arange(len(firsts))
    while len(pos):
        found.append((lane, pos))
        pos = pos + step[pos]
        on = pos < until
        pos, until, lane = pos[on], until[on], lane[on]
    starts = np.sort(np.concatenate([p for _, p in found]))
    sel = choice[starts]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        own = np.flatnonzero(sel == s)
        if not len(own):
            continue
        src = starts[own][:, None] + np.arange(COUNTS[s])
        values = np.where(src < ends[starts[own]][:, None], ids[np.minimum(src, n - 1)], np.uint64(0))
        words[own] |= np.bitwise_or.reduce(values << (np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s])), axis=1)
    out = np.flatnonzero(sel == ESCAPE)
    words[out] |= np.arange(len(out), dtype=np.uint64)
    return words, np.append(np.searchsorted(starts, firsts), len(words)), ids[starts[out]]


def decode_blocks(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids that ``encode_blocks`` coded, all blocks at once."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[sel]
    before = np.concatenate([[0], np.cumsum(counts)])
    which = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = which * block + before[:-1] - before[offsets[:-1]][which]  # of each word in the ids
    until = np.minimum((which + 1) * block, n)
    out = np.zeros(n, np.uint64)
    for s in range(2, 16):
        own = np.flatnonzero(sel == s)
        if not len(own):
            continue
        to = start[own][:, None] + np.arange(COUNTS[s])
        values = (words[own][:, None] >> (np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s]))) & np.uint64((1 << int(WIDTHS[s])) - 1)
        fits = to < until[own][:, None]
        out[to[fits]] = values[fits]
    own = np.flatnonzero(sel == ESCAPE)
    out[start[own]] = escapes[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def pack(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """The bytes of one file; doc_ids may hold None."""
    words, offsets, escapes = encode_blocks(ids)
    head = np.array([BLOCK, len(doc_ids), len(ids), len(words), len(offsets), len(escapes)], "<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    parts = (head, numbers, np.array(lengths, "<u8"), offsets.astype("<u8"), words.astype("<u8"), escapes.astype("<u8"), known)
    return MAGIC + b"".join(p.tobytes() for p in parts)


def unpack(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a file."""
    if payload[:8] != MAGIC:
        raise ValueError("not a token file")
    block, docs, n, words, offsets, escapes = (int(x) for x in np.frombuffer(payload, "<u8", 6, 8))
    at = 56

    def take(count, kind):
        nonlocal at
        got = np.frombuffer(payload, kind, count, at)
        at += got.nbytes
        return got

    numbers, lengths, off = take(docs, "<i8"), take(docs, "<u8").astype(np.int64), take(offsets, "<u8").astype(np.int64)
    w, e, known = take(words, "<u8"), take(escapes, "<u8"), take(docs, "u1")
    return [int(d) if k else None for d, k in zip(numbers, known)], lengths, decode_blocks(w, off, e, n, block)


_ENCODERS: dict[str, object] = {}


class ByteLevelEncoder:
    """Ids of the tokenizers library's byte-level BPE. Runs between blanks that recur are looked up.

    The library cuts a text before every blank that something else than white space follows, so what
    stands between two such blanks has ids of its own. Texts with other characters than those of
    ``PLAIN``, with a blank before white space or at the end, or with a special token's string go to
    the library whole.
    """

    PLAIN = bytes([9, 10, 13, *range(32, 127), *range(161, 256)])  # in Latin-1
    WIDE = ("  ", " \n", " \t", " \r")
    MARKS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~"

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # else the library starts as many threads as the machine has cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known, self.most = {}, most
        self.marks = Cache(lambda m: np.array(self.library.encode(m, add_special_tokens=False).ids, np.uint32).tobytes(), 10_000)
        #: Tokens that begin with a blank, in the library's alphabet for bytes.
        self.blank = np.array([(self.library.id_to_token(i) or "").startswith("\u0120") for i in range(self.library.get_vocab_size())])

    def plain(self, text: str) -> bool:
        try:
            if text.encode("latin-1").translate(None, self.PLAIN):
                return False
        except UnicodeEncodeError:
            return False
        return not (text.endswith(" ") or any(w in text for w in self.WIDE) or any(s in text for s in self.special))

    def learn(self, runs: list[str]) -> None:
        """Encode runs, 64 in one text; each token that begins with a blank begins a run.

        Marks after a letter or digit are cut off by the library as well, so a word is encoded once
        whatever marks follow it.
        """
        known, ends, bare = self.known, {}, {}
        for run in runs:
            if not run or run[-1].isalnum():
                bare[run] = None
                continue
            word = run.rstrip(self.MARKS)
            if word and word[-1].isalnum():
                ends[run] = word
                if word not in known:
                    bare[word] = None
            else:
                bare[run] = None
        bare = list(bare)
        groups = [bare[i : i + 64] for i in range(0, len(bare), 64)]
        for group, got in zip(groups, self.library.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(got.ids, np.uint32)
            cuts = np.append(np.flatnonzero(self.blank[ids]), len(ids)) * 4
            raw = ids.tobytes()
            for run, a, b in zip(group, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                known[run] = raw[a:b]
        for run, word in ends.items():
            known[run] = known[word] + self.marks[run[len(word) :]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.plain(t) for t in texts]
        cut = [t.split(" ") if p else None for t, p in zip(texts, plain)]
        first = [c[0] if c else t for c, t in zip(cut, texts)]
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        self.learn(list(set(chain.from_iterable(c[1:] for c in cut if c)).difference(known)))
        out = []
        for c, got in zip(cut, self.library.encode_batch_fast(first, add_special_tokens=False)):
            head = np.array(got.ids, np.uint32)
            out.append(np.frombuffer(head.tobytes() + b"".join(map(known.__getitem__, c[1:])), np.uint32) if c else head)
        return out


def encoder(path: str) -> ByteLevelEncoder:
    """One encoder a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteLevelEncoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """Write the ids of (doc_id, text) to ``path``, in ascending doc_id order by (part, seq)."""
    from pyspark import TaskContext

    from tidemark.llm.common import chunks

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(vocabulary)
        ids, lengths, numbers, total = [], [], [], 0

        def file():
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seq]), pa.array([pack(numbers, lengths, np.concatenate(ids))]), pa.array([total])], names=["part", "seq", "payload", "n_ids"])

        for b in chunks(batches):
            for number, got in zip(b.column(0).to_pylist(), enc.encode([t or "" for t in b.column(1).to_pylist()])):
                ids += [got, np.array([end_id], np.uint32)]
                lengths.append(len(got) + 1)
                numbers.append(number)
                total += len(got) + 1
                if total >= file_ids:
                    yield file()
                    ids, lengths, numbers, total, seq = [], [], [], 0, seq + 1
        if numbers:
            yield file()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(ordered, run, "part long, seq long, payload binary, n_ids long").write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files."""

    def decode(b):
        out = {k: [] for k in ("part", "seq", "doc_id", "local", "n_tokens", "ids_crc32")}
        for part, seq, payload in zip(*(b.column(k).to_pylist() for k in range(3))):
            numbers, lengths, ids = unpack(payload)
            raw = memoryview(ids.astype("<u4").tobytes())
            begin = np.cumsum(lengths) - lengths
            for number, a, n in zip(numbers, begin.tolist(), lengths.tolist()):
                for k, v in zip(out, (part, seq, number, a, n, zlib.crc32(raw[4 * a : 4 * (a + n)]))):
                    out[k].append(v)
        return out

    files = spark.read.parquet(path)
    docs = map_rows(files.select("part", "seq", "payload"), decode, "part long, seq long, doc_id long, local long, n_tokens long, ids_crc32 long", text=None)
    # a row a part, as many as the write had tasks; then a running sum inside each part
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    within = files.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("inner"))
    starts = within.join(parts, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("first"))
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-file")
    write(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), path)
    return read(spark, path)
