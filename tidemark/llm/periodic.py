"""Periodic runs of words by heavy/light lag counting.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) that is at
least max(``LEAST``, ``TIMES`` * q) long and that no neighbouring word extends at that period. A text with
such a run has at least max(LEAST - q, (TIMES - 1) * q) places whose word comes again q words on. These are
counted exactly for every lag q: words that occur often by FFT autocorrelation of where they stand, the
others by the differences of their places. Only lags with enough matches are scanned for islands of
consecutive matches. An island of that many matches holds a whole aligned block of half as many, so a scan
compares n / q block hashes and then follows the matches word by word from the blocks that agree. A stretch
that lies in a known run of a divisor of q has that period and is left out, so a text of one word repeated
costs n log n, too.

Edge cases: a null or blank text has no words and no runs; a text is taken whole, however long, with memory
in proportion to it; each row is judged by itself, so repeated rows and null ids give rows of their own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table

QUERY = "op11_periodic_runs"
LEAST, TIMES = 24, 3
#: Elements of the arrays that are transformed at once, and differences counted at once.
AT_ONCE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def matches(ids: np.ndarray, lags: int, heavy: int | None = None) -> np.ndarray:
    """For each lag q up to ``lags``, how many places i have ids[i] == ids[i + q]; words beyond ``heavy`` times go by FFT."""
    n, out = len(ids), np.zeros(lags + 1, np.int64)
    heavy = heavy or max(24, int(n**0.5))
    often = np.bincount(ids)
    order = np.argsort(ids, kind="stable")
    word = ids[order]
    rare = often[word] <= heavy
    at, word = order[rare], word[rare]
    left, d, found, held = np.arange(len(at) - 1), 1, [], 0
    while left.size:
        left = left[word[left + d] == word[left]]
        found.append(at[left + d] - at[left])
        held, d = held + left.size, d + 1
        left = left[: np.searchsorted(left, len(at) - d)]
        if held > AT_ONCE or not left.size:
            lag = np.concatenate(found)
            out += np.bincount(lag[lag <= lags], minlength=lags + 1)
            found, held = [], 0
    words, size = np.flatnonzero(often > heavy), 1 << (n + lags).bit_length()
    for k in range(0, len(words), per := max(1, AT_ONCE // size)):
        f = np.fft.rfft(ids[None, :] == words[k : k + per, None], size)
        # each word's counts are rounded by themselves: their error is far below a half
        out += np.rint(np.fft.irfft(f.real**2 + f.imag**2, size)[:, : lags + 1]).astype(np.int64).sum(0)
    out[0] = n
    return out


def _left(ids: np.ndarray, q: int, at: int) -> int:
    """Where the matches at lag q that end before ``at`` begin."""
    step = 64
    while at > 0:
        lo = max(0, at - step)
        bad = np.flatnonzero(ids[lo:at] != ids[lo + q : at + q])
        if bad.size:
            return lo + int(bad[-1]) + 1
        at, step = lo, 2 * step
    return 0


def _right(ids: np.ndarray, q: int, at: int) -> int:
    """Where the matches at lag q from ``at`` end."""
    step, end = 64, len(ids) - q
    while at < end:
        hi = min(end, at + step)
        bad = np.flatnonzero(ids[at:hi] != ids[at + q : hi + q])
        if bad.size:
            return at + int(bad[0])
        at, step = hi, 2 * step
    return end


def islands(ids: np.ndarray, hashes: np.ndarray, powers: np.ndarray, q: int, least: int, known: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches [start, end) of ``least`` and more consecutive matches at lag q, but for those that a run in
    ``known`` (rows start, end, period) holds whose period divides q."""
    n, block = len(ids), least // 2
    at = np.arange(0, n - q - block + 1, block)
    own, other = hashes[at + block] - hashes[at], hashes[at + q + block] - hashes[at + q]
    at = at[own * powers[q] == other]
    for start, end, _ in known[(q % known[:, 2] == 0) & (known[:, 1] - known[:, 0] >= block + q)] if at.size else ():
        at = at[(at < start) | (at + block + q > end)]
    done = 0
    for s in at.tolist():
        if s < done or (ids[s : s + block] != ids[s + q : s + q + block]).any():
            continue
        start, done = _left(ids, q, s), _right(ids, q, s + block)
        if done - start >= least:
            yield start, done


def runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run, by start and period."""
    n = len(ids)
    if n < least:
        return []
    need = lambda q: max(least - q, (times - 1) * q)
    lags = np.arange(n // times + 1)
    enough = np.flatnonzero(matches(ids, n // times) >= np.maximum(least - lags, (times - 1) * lags))[1:]
    if not enough.size:
        return []
    powers = np.full(n + 1, _BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    value = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
    hashes = np.concatenate([np.zeros(1, np.uint64), np.cumsum((value ^ (value >> np.uint64(29))) * powers[:n])])
    found = np.zeros((0, 3), np.int64)
    for q in enough.tolist():
        if new := [(s, e + q, q) for s, e in islands(ids, hashes, powers, q, need(q), found)]:
            found = np.concatenate([found, np.array(new, np.int64)])
    return sorted((s, e - s, q) for s, e, q in found.tolist())


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those of a run after its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def best(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period, and of these the first, then that of the smallest period."""
    return max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def find(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed): the runs of each text, the most repetitive one (or null), and the
    words joined by blanks without what runs repeat. Words are cut at ASCII blanks."""

    def batch(b):
        out = {k: [] for k in ("doc_id", "n_words", "runs", "best", "collapsed")}
        as_row = lambda r: r and dict(zip(("start", "length", "period"), r))
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words, number = (text or "").encode("utf-8", "surrogatepass").split(), {}
            ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
            found = runs(ids, least, times)
            for k, v in zip(out, (doc_id, len(words), [as_row(r) for r in found], as_row(best(found)), b" ".join(collapse(words, found)).decode("utf-8", "surrogatepass"))):
                out[k].append(v)
        return out

    run = "struct<start:long,length:long,period:long>"
    return map_rows(docs.select("doc_id", "text"), batch, f"doc_id long, n_words long, runs array<{run}>, best {run}, collapsed string")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in texts whose doc_id's crc32 ends in 0 the words from some place on are those of a period from there on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when((h % 10 == 0) & F.col("text").isNotNull(), words).alias("w"))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.concat_ws(" ", F.slice("w", F.lit(1), a), F.slice(again, F.lit(1), (n - a).cast("int")))
    return rows.select("doc_id", F.when(F.size("w") > 0, text).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(repeated(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
