"""BPE as a streaming transducer with bounded lookahead, and decoding as a state machine.

Two tokens may stand side by side if the merges make just these two of their symbols, and a sequence is what the merges
make of it if all its neighbours may. So what stands before a place has one last token, found from those of earlier places;
and only at *open* places, from which what has been read since is the beginning of a token, can the token that covers the
next symbol begin. Tokens on the way to all open places are stable whatever follows: ``Transducer`` emits them and
forgets their symbols, often in the middle of a word.

How much it holds is bounded by the merge list's sufficient lookahead (``MergeList.lookahead``): a merge (u, v) whose v
starts at the first difference moves that difference left by u, and the next merge to move it must have u on the left spine of
its own v and come later in the list; the longest such chain is as far as what follows a place can move boundaries before it.
So no more than that and two tokens are held (``Transducer.bound``), and memory does not grow with the word or the text.
``TextDecoder`` turns ids into text piece by piece, holding at most an unfinished UTF-8 character.

Edge cases: a null or empty text has no ids and decodes to the empty text; rows come back as often as
they are given, null doc_ids as null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Cache, map_rows, table

QUERY = "op7_stream_bpe"
#: Characters of text that are cut into words at a time.
SEGMENT = 1 << 16
#: The longest run of text whose ids a worker keeps for when it recurs; longer ones are streamed each time.
KEPT_LENGTH = 64
#: Symbols, and so many more for each state, that the states a transducer keeps may hold; beyond, it begins anew.
STATE_SYMBOLS, STATE_COST = 3_000_000, 8


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class MergeList:
    """A merge list in priority order over symbols, with its sufficient lookahead in symbols.

    Symbols are single characters, and a word's last one has ``suffix`` added.
    """

    def __init__(self, merges: list[tuple[str, str]], suffix: str = ""):
        self.rank, self.suffix = {}, suffix
        for k, pair in enumerate(merges):
            self.rank.setdefault(tuple(pair), k)
        left: dict[str, set[str]] = {}
        size: dict[str, int] = {}
        chain: dict[str, int] = {}  # by token u: how far back merges (u, .) can carry a difference
        self.lookahead, self.longest = 0, 1
        spines: dict[str, frozenset] = {}

        def spine(t: str) -> frozenset:
            if t not in spines:
                spines[t] = frozenset({t}).union(*(spine(x) for x in left.get(t, ())))
            return spines[t]

        for u, v in merges:
            # tokens are made before they are used, so the spines of u and v are complete
            far = size.get(u, 1) + max((chain.get(t, 0) for t in spine(v)), default=0)
            chain[u] = max(chain.get(u, 0), far)
            self.lookahead = max(self.lookahead, far)
            left.setdefault(u + v, set()).add(u)
            size[u + v] = size.get(u, 1) + size.get(v, 1)
            self.longest = max(self.longest, size[u + v])
            spines.pop(u + v, None)
        self.tokens = {u + v for u, v in merges}
        stems = (t.removesuffix(suffix) for t in self.tokens)
        #: by text: 1 if a token may begin with it before its last symbol, 2 if it is a token, 3 if both
        self.kinds = dict.fromkeys((t[:k] for t in stems for k in range(1, len(t))), 1)
        for t in self.tokens:
            self.kinds[t] = self.kinds.get(t, 0) | 2
        self.together, self.made = Cache(self._together, 200_000), Cache(self._made, 60_000)
        #: by token its last merge: rank, left and right part; None if several merges make it
        self.split: dict[str, tuple[int, str, str] | None] = {}
        for (u, v), k in self.rank.items():
            self.split[u + v] = None if u + v in self.split else (k, u, v)

    def _made(self, part: tuple[str, bool]) -> bool:
        """Whether the merges make the token of its symbols."""
        t, ended = part
        end = self.suffix if ended else ""
        return self.apply([*t[:-1], t[-1] + end]) == [t + end]

    def _together(self, pair: tuple[str, str, bool]) -> bool:
        """Whether the merges make a and b of their symbols; a is empty at the start, b is given without the suffix at the end.

        Between tokens that are made by one merge each, merges are taken back from the last one on: what then meets
        across the place must not be a merge that comes before the one that was taken back.
        """
        a, b, ended = pair
        if not self.made[b, ended]:
            return False
        if not a:
            return True
        rank, split, limit = self.rank.get, self.split.get, 1 << 60
        x, y = a, b + self.suffix if ended else b
        none = (-1, "", "")
        while rank((x, y), 1 << 60) >= limit:
            left, right = split(x, none), split(y, none)
            if left is None or right is None:
                break
            if left[0] > right[0]:
                limit, x = left[0], left[2]
            elif right[0] >= 0:
                limit, y = right[0] + 1, right[1]
            else:
                return self.made[a, False]
        else:
            return False
        end = self.suffix if ended else ""
        return self.apply([*a, *b[:-1], b[-1] + end]) == [a, b + end]

    def apply(self, symbols: list[str]) -> list[str]:
        """The tokens of a whole sequence of symbols: the pair that is first in the list is merged first, from the left."""
        rank = self.rank
        if len(symbols) <= 64:
            none, get = 1 << 30, rank.get
            ranks = [get(p, none) for p in zip(symbols, symbols[1:])]
            while ranks and (best := min(ranks)) < none:
                i = ranks.index(best)
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((symbols[i - 1], symbols[i]), none)
                if i < len(ranks):
                    ranks[i] = get((symbols[i], symbols[i + 1]), none)
            return symbols
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, None
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (p := (symbols[i], symbols[k])) in rank:
                    heapq.heappush(heap, (rank[p], i, *p))
            if (h := before[i]) >= 0 and (p := (symbols[h], symbols[i])) in rank:
                heapq.heappush(heap, (rank[p], h, *p))
        return [s for s in symbols if s is not None]


class Recent(Cache):
    """A cache whose entries have a second life: what was used since it was last emptied comes back without being made again."""

    def __init__(self, make, most: int = 200_000):
        super().__init__(make, most)
        self.before: dict = {}

    def __missing__(self, key):
        if len(self) >= self._most:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value


class State:
    """What a transducer knows after some symbols: what it holds, the last tokens before its places, the open places,
    and the next state and the tokens given (``on``), or the last tokens (``ends``), for each next symbol met so far.
    """

    __slots__ = ("held", "last", "open", "on", "ends")

    def __init__(self, held: str, last: list[str], places: list[int]):
        self.held, self.last, self.open, self.on, self.ends = held, last, places, {}, {}


class Transducer:
    """Tokens of words from their symbols as they come.

    The token before what is held, and what is held, are all of its state, so the states and steps that ``word`` meets
    are kept: words that begin alike, or go on alike after tokens that were given, take the same ones.

    ``push`` gives tokens once nothing to come can change them, ``finish`` ends the word and gives the rest.
    ``held`` are the symbols after the last token given, at most ``bound``; the one read last waits apart, as it
    may be the word's end.
    """

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.bound = merges.lookahead + 2 * merges.longest
        self.states: dict[tuple[str, str], State] = {}
        self._forget()
        self._start()

    def _forget(self) -> None:
        for state in self.states.values():  # they go at once, also those on a way back to themselves
            state.on.clear()
        self.first = State("", [""], [0])
        self.states, self.kept = {("", ""): self.first}, 0

    def _start(self) -> None:
        self.held, self.waiting = "", ""
        # by place in what is held: the last token before it; and the open places
        self.last, self.open = [""], [0]

    def _place(self, text: str, upto: int, last: list[str], places: list[int], end: str = "") -> tuple[str, list[int]]:
        """The last token of text[:upto], without the suffix ``end``, and the open places there."""
        kinds, together, found, still = self.merges.kinds.get, self.merges.together, None, []
        for p in places:
            t = text[p:upto]
            kind = kinds(t + end, 0)
            if found is None and (kind > 1 or p == upto - 1) and together[last[p], t, end != ""]:
                found = t
            if kind & 1:
                still.append(p)
        still.append(upto)
        return found, still

    @staticmethod
    def _before(last: list[str], place: int, given: int = 0) -> list[str]:
        """The tokens between two places."""
        out = []
        while place > given:
            out.append(last[place])
            place -= len(out[-1])
        return out[::-1]

    @staticmethod
    def _common(last: list[str], places: list[int]) -> int:
        """The furthest place on the way to all of the places."""
        way = places[0]
        for p in places[1:]:
            while p != way:
                if p > way:
                    p -= len(last[p])
                else:
                    way -= len(last[way])
            if not way:
                break
        return way

    def _read(self, symbol: str, end: str = "") -> None:
        self.held += symbol
        found, self.open = self._place(self.held, len(self.held), self.last, self.open, end)
        self.last.append(found)

    def _stable(self) -> list[str]:
        """The tokens on the way to all open places, which are then forgotten."""
        if not self.open[0]:
            return []
        place = self._common(self.last, self.open)
        out = self._before(self.last, place)
        self.held, self.last, self.open = self.held[place:], self.last[place:], [p - place for p in self.open]
        return out

    def push(self, symbols: Iterable[str]) -> Iterator[str]:
        for s in symbols:
            if self.waiting:
                self._read(self.waiting)
                yield from self._stable()
            self.waiting = s

    def finish(self) -> Iterator[str]:
        if self.waiting:
            self._read(self.waiting, self.merges.suffix)
            *out, final = self._before(self.last, len(self.held))
            yield from out
            yield final + self.merges.suffix
        self._start()

    def word(self, symbols: Iterable[str]) -> list[str]:
        """All tokens of a word that is here as a whole; one within the bound keeps its symbols to its end."""
        text = symbols if isinstance(symbols, str) else "".join(symbols)
        if self.waiting or not 0 < len(text) <= self.bound:
            return [*self.push(text), *self.finish()]
        state, out = self.first, []
        for symbol in text[:-1]:
            step = state.on.get(symbol) or self._step(state, symbol)
            state = step[0]
            if step[1]:
                out += step[1]
        return out + (state.ends.get(text[-1]) or self._end(state, text[-1]))

    def _keep(self, n: int) -> None:
        self.kept += n + STATE_COST
        if self.kept > STATE_SYMBOLS:
            self._forget()

    def _step(self, state: State, symbol: str) -> tuple[State, Sequence[str]]:
        """The state after one more symbol, and the tokens that are stable by then."""
        held, given, last, places, found = state.held + symbol, (), state.last, [], None
        kinds, together, final, left = self.merges.kinds.get, self.merges.together, len(held) - 1, iter(state.open)
        for p in left:  # as in ``_place``
            t = held[p:]
            kind = kinds(t, 0)
            if kind & 1:
                places.append(p)
            if (kind > 1 or p == final) and together[last[p], t, False]:
                found = t
                break
        places += [p for p in left if kinds(held[p:], 0) & 1]
        places.append(final + 1)
        last = [*last, found]
        if places[0]:
            if place := self._common(last, places):
                given = self._before(last, place)
                held, last, places = held[place:], last[place:], [p - place for p in places]
        after = self.states.get((last[0], held))
        if after is None:
            self._keep(len(held))
            after = self.states[last[0], held] = State(held, last, places)
        step = state.on[symbol] = after, given
        return step

    def _end(self, state: State, symbol: str) -> list[str]:
        """The rest of a word's tokens if the symbol is its last one."""
        held, last, suffix = state.held + symbol, state.last, self.merges.suffix
        kinds, together, final = self.merges.kinds.get, self.merges.together, len(held) - 1
        for p in state.open:  # the longest token that may end the word
            t = held[p:]
            if (p == final or kinds(t + suffix, 0) > 1) and together[last[p], t, suffix != ""]:
                break
        out = self._before(last, p)
        out.append(t + suffix)
        self._keep(len(out))
        state.ends[symbol] = out
        return out


class TextDecoder:
    """Text of ids, piece by piece. The state is an unfinished character's bytes and whether a token came."""

    def __init__(self, raw: dict[int, bytes], between: bytes = b""):
        self.raw, self.between, self.begun = raw, between, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        got = self.between.join(map(self.raw.__getitem__, ids))
        if not got and not ids:
            return ""
        got, self.begun = (self.between + got if self.begun else got), True
        return self.utf8.decode(got)

    def finish(self) -> str:
        return self.utf8.decode(b"", final=True)


class WordBpe:
    """The tokenizers library's lower-casing word BPE: NFC, lower case, words, bytes, merges with word ends.

    Every word goes through a ``Transducer``; what it gave for short runs between white space is looked
    up when they recur. Texts with other characters than those of
    ``PLAIN``, whose classes depend on the Unicode version, are put in NFC and cut into words by the library.
    """

    PLAIN = bytes([9, 10, 13, *range(32, 127), *range(161, 256)])  # in Latin-1, all in NFC

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.ids = model["vocab"]
        self.merges = MergeList([tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.number = {t: str(i) for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        self.library = Tokenizer.from_file(path)
        self.byte = {c: b for b, c in enumerate(self.letters)}
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^\s\p{{L}}\p{{N}}]+")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.break_ = regex.compile(r"[ \t\n\r]")
        self.raw = {i: t.encode() for t, i in [*self.ids.items(), *self.special.items()]}
        self.raw_text = {str(i): t for i, t in self.raw.items()}
        self.transducer = Transducer(self.merges)
        self.runs, self.spelled = Recent(self.spell_run, 200_000), Recent(self.spell, 200_000)

    def spell(self, word: str) -> str:
        """The ids of a word, joined by blanks."""
        symbols = word if word.isascii() and word.isprintable() else word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return " ".join([self.number[t] for t in self.transducer.word(symbols)])

    def spell_run(self, run: str) -> str:
        """The ids of a short run without white space."""
        if run.isalpha():  # one word
            return self.spelled[run]
        return " ".join(map(self.spelled.__getitem__, self.words.findall(run)))

    def tokens(self, word: str) -> Iterator[str]:
        """A word's tokens as they become stable."""
        letters, one = self.letters, Transducer(self.merges)
        yield from one.push(letters[b] for c in word for b in c.encode("utf-8", "surrogatepass"))
        yield from one.finish()

    def plain(self, segment: str) -> bool:
        try:
            return not segment.encode("latin-1").translate(None, self.PLAIN)
        except UnicodeEncodeError:
            return False

    def library_words(self, segment: str) -> list[str]:
        lib, byte = self.library, self.byte
        found = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(segment))
        return [bytes(map(byte.__getitem__, w)).decode("utf-8") for w, _ in found]

    def segments(self, text: str) -> Iterator[str]:
        """The text in runs of about SEGMENT characters; runs end after a blank, where no word goes on."""
        at = 0
        while len(text) - at > SEGMENT:
            m = self.break_.search(text, at + SEGMENT)
            if not m:
                break
            yield text[at : m.end()]
            at = m.end()
        yield text[at:] if at else text

    def encode(self, text: str) -> Iterator[str]:
        """Ids joined by blanks, in pieces that are not empty."""
        for k, part in enumerate(self.cut.split(text) if "<|" in text else (text,)):
            if k % 2:
                yield str(self.special[part])
                continue
            for segment in self.segments(part):
                if self.plain(segment):
                    runs, known, cut = segment.lower().split(), self.runs, self.words.findall
                else:
                    runs, known, cut = self.library_words(segment), self.spelled, lambda word: [word]
                if not runs:
                    continue
                if len(max(runs, key=len)) <= KEPT_LENGTH:
                    yield " ".join(map(known.__getitem__, runs))
                    continue
                for run in runs:
                    if len(run) <= KEPT_LENGTH:
                        yield known[run]
                        continue
                    for word in cut(run):
                        yield from self.stream(word)

    def stream(self, word: str) -> Iterator[str]:
        """The ids of a long word, some hundreds at a time."""
        held = []
        for t in self.tokens(word):
            held.append(self.number[t])
            if len(held) == 512:
                yield " ".join(held)
                held = []
        if held:
            yield " ".join(held)

    def decoder(self) -> TextDecoder:
        return TextDecoder(self.raw_text, b" ")


_ENCODERS: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """One encoder a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
        gc.freeze()  # the vocabulary and merges stay; they need not be walked through each time
    return _ENCODERS[path]


def digest(enc: WordBpe, text: str) -> tuple[int, str, str]:
    """(n_tokens, SHA-256 of the ids joined by blanks, SHA-256 of the decoded text)."""
    ids, back, out, n = hashlib.sha256(), hashlib.sha256(), enc.decoder(), 0
    for piece in enc.encode(text):
        ids.update((" " + piece if n else piece).encode())
        got = piece.split(" ")
        n += len(got)
        back.update(out.push(got).encode("utf-8"))
    back.update(out.finish().encode("utf-8"))
    return n, ids.hexdigest(), back.hexdigest()


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row."""

    def batch(b):
        enc = encoder(vocabulary)
        got = [digest(enc, t or "") for t in b.column(1).to_pylist()]
        return {"doc_id": b.column(0), "n_tokens": [g[0] for g in got], "ids_sha256": [g[1] for g in got], "decoded_sha256": [g[2] for g in got]}

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), batch, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for each row: the ids and the text that they give back."""

    def batch(b):
        enc = encoder(vocabulary)
        ids, texts = [], []
        for t in b.column(1).to_pylist():
            out, own, parts = enc.decoder(), [], []
            for piece in enc.encode(t or ""):
                got = piece.split(" ")
                own += map(int, got)
                parts.append(out.push(got))
            ids.append(own)
            texts.append("".join(parts) + out.finish())
        return {"doc_id": b.column(0), "n_tokens": list(map(len, ids)), "ids": ids, "decoded": texts}

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), batch, "doc_id long, n_tokens long, ids array<int>, decoded string")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
