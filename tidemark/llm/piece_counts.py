"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie with two roots: whole words and words' first pieces start at one, later
pieces at the other. Where a node has no child for the next character, its failure link leads to the
node where matching goes on, and a number says how many pieces are complete by then. A word is read
once from left to right; its pieces are counted and never built.

A word is a run of letters, digits and underscores, or one other character that is not white space.
A word that the vocabulary can't spell counts as one unknown piece. Edge cases: a null or empty text
has no words; null doc_ids stay null; repeated rows come back as often; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Cache, map_rows, table

QUERY = "op4_piece_counts"
WORD = re.compile(r"\w+|[^\w\s]")
#: Bits for each of the sums that are carried in one number.
FIELD = 48


class Automaton:
    """Longest-match counts over first pieces and later pieces."""

    FIRST, LATER = 0, 1

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        token = [False, False]
        for root, pieces in ((self.FIRST, first), (self.LATER, later)):
            for piece in pieces:
                at = root
                for c in piece:
                    to = self.next[at].get(c)
                    if to is None:
                        to = self.next[at][c] = len(self.next)
                        self.next.append({})
                        token.append(False)
                    at = to
                token[at] = at > 1
        #: Failure links (-1: none) and the pieces popped on the way.
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        queue = deque([self.FIRST, self.LATER])
        while queue:
            at = queue.popleft()
            for c, to in self.next[at].items():
                queue.append(to)
                if token[to]:
                    self.fail[to], self.pops[to] = self.LATER, 1
                    continue
                via, popped = self.fail[at], self.pops[at]
                while via >= 0 and c not in self.next[via]:
                    popped += self.pops[via]
                    via = self.fail[via]
                if via >= 0:
                    self.fail[to], self.pops[to] = self.next[via][c], popped

    def count(self, word: str) -> int:
        """Pieces of the word, or -1 if it can't be spelled."""
        at, n, step, fail, pops = self.FIRST, 0, self.next, self.fail, self.pops
        for c in word:
            while (to := step[at].get(c)) is None:
                if fail[at] < 0:
                    return -1
                n += pops[at]
                at = fail[at]
            at = to
        while at != self.LATER:
            if fail[at] < 0:
                return -1
            n += pops[at]
            at = fail[at]
        return n


def load(path: str) -> Automaton:
    """From a sentencepiece model (pieces that begin a word carry its mark) or a list with ## before later pieces."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        marked = lambda p: p.startswith("▁")
        return Automaton([p[1:] for p in pieces if marked(p)], [p for p in pieces if not marked(p)])
    with open(path, encoding="utf-8") as f:
        pieces = f.read().splitlines()
    return Automaton([p for p in pieces if not p.startswith("##")], [p[2:] for p in pieces if p.startswith("##")])


_COUNTERS: dict[str, Cache] = {}


def counter(path: str) -> Cache:
    """Run of text between blanks -> words, pieces and unknown words in one number; one a worker process."""
    if path not in _COUNTERS:
        automaton = load(path)

        def run(text: str) -> int:
            counts = [automaton.count(w) for w in WORD.findall(text)]
            return len(counts) | sum(abs(n) for n in counts) << FIELD | counts.count(-1) << 2 * FIELD

        _COUNTERS[path] = Cache(run, 400_000)
    return _COUNTERS[path]


def counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_pieces, n_unknown); n_pieces counts an unknown word as one."""

    def batch(b):
        known, low = counter(vocabulary), (1 << FIELD) - 1
        sums = [sum(known[r] if len(r) <= 64 else known._make(r) for r in (t or "").split()) for t in b.column(1).to_pylist()]
        return {"doc_id": b.column(0), "n_words": [s & low for s in sums], "n_pieces": [s >> FIELD & low for s in sums], "n_unknown": [s >> 2 * FIELD for s in sums]}

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), batch, "doc_id long, n_words long, n_pieces long, n_unknown long")


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(table(spark, sf_dir, "documents"), vocabulary())
