"""Operators with exact results, against brute force written out here."""

import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, piece_counts, pii, simhash, stream_bpe, token_file, webp

ODD = [(1, "a b c d e"), (1, "a b c d e"), (2, None), (3, ""), (None, "x y z"), (4, "lone"), (5, "w " * 3000), (6, "é 日本 😀 \x00 \t\n z")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, repeated, long rows, and extra columns with clashing names."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    return rows.withColumns({"score": F.lit("x"), "fp": F.lit(1.5), "kind": F.lit(None).cast("int"), "h": F.lit("h"), "pos": F.lit(0)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# ---- webp


@pytest.mark.parametrize("shape", [(1, 1, 1), (1, 7, 2), (5, 9, 3), (9, 5, 16), (12, 13, 40), (20, 17, 200)])
def test_webp_image_round_trip(shape):
    h, w, k = shape
    r = np.random.default_rng(sum(shape))
    pixels = r.integers(0, 1 << 32, k, dtype=np.uint64).astype(np.uint32)[r.integers(0, k, (h, w))]
    small, large = (-(-h >> 2), -(-w >> 2)), (-(-h >> 3), -(-w >> 3))
    modes = (webp.PREDICTOR, r.integers(0, 14, small), 2)
    cross = (webp.CROSS_COLOUR, r.integers(0, 1 << 24, large).astype(np.uint32), 3)
    for transforms in ([], [(webp.SUBTRACT_GREEN,)], [modes], [cross], [modes, cross, (webp.SUBTRACT_GREEN,)], [(webp.PALETTE,)]):
        for cache in (0, 1, 6):
            for lz in (False, True):
                blocks = r.integers(0, 3, small) if transforms[:1] != [(webp.PALETTE,)] else None
                for b in (None, blocks):
                    data = webp.encode_image(pixels, transforms, cache, lz, b, 2 if b is not None else 0)
                    assert (webp.decode_image(data) == pixels).all()


def test_webp_fixed_values():
    assert len(webp.NEAR) == 120 and webp.NEAR[:6] == [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0)] and webp.NEAR[-1] == (8, 7)
    # a 1 x 1 image, written by hand: no transform, cache or meta codes; five codes of one symbol
    bits = "".join(f"{v:0{n}b}"[::-1] for v, n in [(0x2F, 8), (0, 14), (0, 14), (0, 4), (0, 1), (0, 1), (0, 1)] + [x for s in (7, 5, 9, 255) for x in [(1, 1), (0, 1), (1, 1), (s, 8)]] + [(1, 1), (0, 1), (0, 1), (0, 1)])
    data = int(bits[::-1], 2).to_bytes((len(bits) + 7) // 8, "little")
    assert webp.decode_image(data).tolist() == [[0xFF050709]]
    with pytest.raises(ValueError):
        webp.decode_image(b"\x00" * 9)
    with pytest.raises(ValueError):
        webp.frames_of(b"RIFF....PNG")


def test_webp_batches_are_valid_images_and_independent():
    r = np.random.default_rng(1)
    texts = ["", "a", "é" * 500, "hello world " * 50, "x" * 20000, *("".join(map(chr, r.integers(32, 400, int(n)))) for n in r.integers(0, 12000, 20))]
    payloads = [webp.payload(t)[0] for t in texts]
    media = webp.store(payloads)
    for p, m, frames in zip(payloads, media, webp.load(media)):
        assert b"".join(f.tobytes() for f in frames) == p
        assert b"".join(webp.to_samples(f).tobytes() for f in webp.decode(m)) == p  # by the general decoder too
        assert webp.store([p]) == [m]


def test_webp_file_of_another_encoder():
    """A published one-pixel probe file, with a colour cache, codes of one symbol and an alpha channel."""
    import base64

    got = webp.decode(base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA=="))
    assert len(got) == 1 and got[0].tolist() == [[0]]


def test_webp_encoder_chooses_by_size():
    kinds = lambda data: bin(int.from_bytes(data[5:6], "little") & 1)  # noqa: E731  whether a transform follows the header
    flat = np.zeros((16, 192, 3), np.uint8)
    slope = np.stack([np.arange(192)[None] + 3 * np.arange(16)[:, None]] * 3, 2).astype(np.uint8)
    line = np.resize(np.frombuffer(b"the same line again and again;", np.uint8), 16 * 192 * 3).reshape(16, 192, 3)
    noise = np.random.default_rng(0).integers(0, 256, (16, 192, 3)).astype(np.uint8)
    for f in (flat, slope, line, noise):
        data = webp.encode_frames([f])[0]
        assert (webp.decode_frames([data])[0] == f).all() and (webp.to_samples(webp.decode_image(data)) == f).all()
        plain = webp.encode_image(webp.to_pixels(f), lz=False)
        assert len(data) <= len(plain) * (0.25 if f is line else 1) if f is not noise else webp._parsed(data) is not None
    r = np.random.default_rng(3)
    steps = np.cumsum(r.integers(0, 3, (16, 192, 1)), axis=1).repeat(3, 2).astype(np.uint8)
    smooth = webp.encode_smallest(webp.to_pixels(steps))
    assert kinds(smooth) and len(smooth) < len(webp.encode_image(webp.to_pixels(steps), cache_bits=4)) and (webp.to_samples(webp.decode_image(smooth)) == steps).all()


def test_webp_rows(spark, odd, empty):
    got = webp.describe(webp.encode_texts(odd)).collect()
    want = collections.Counter()
    for i, t in ODD:
        raw = (t or "").encode()
        raw += b"\xff" * (-len(raw) % 576 if raw else 576)
        want[i, len((t or "").encode()), len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:])] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    assert len({(r.media_sha256, r.feature) for r in got if r.doc_id == 1}) == 1
    assert webp.describe(webp.encode_texts(empty)).count() == 0


# ---- chat


def test_chat_round_trip():
    r = random.Random(0)
    for _ in range(1500):
        turns = [("".join(r.choice("\\#</turn>\n a") for _ in range(r.randrange(6))), "".join(r.choice(["\\", "### ", "</turn>", "\n", "a", "#", "</turn>\n"]) for _ in range(r.randrange(8)))) for _ in range(r.randrange(1, 4))]
        line, reader, got = "".join(chat.render_turn(*t)[0] for t in turns), chat.Reader(), []
        cuts = sorted(r.randrange(len(line) + 1) for _ in range(r.randrange(6)))
        for a, b in zip([0, *cuts], [*cuts, len(line)]):
            for what, part in reader.feed(line[a:b]):
                if what == "role":
                    got.append([part, ""])
                elif what == "text":
                    got[-1][1] += part
        assert [tuple(g) for g in got] == turns and not reader.held
        for role, text in turns:
            piece, a, b = chat.render_turn(role, text)
            assert chat.unescape(piece[a:b]) == text


def test_chat_layouts(spark):
    rows = [
        (1, {"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}),
        (2, {"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}),
        (3, {"id": 3, "instruction": "q", "input": "", "output": "a"}),
        (4, {"prompt": "q", "completion": "a", "extra": {"x": [1]}}),
        (5, {"data": {"question": "q", "answer": "a"}}),
        (6, {"nothing": 1}),
        (7, []),
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in rows] + [(8, None), (9, "damaged")], "i long, j string")
    got = collections.defaultdict(list)
    for r in chat.from_json(df, "i", "j").orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    assert dict(got) == {i: [("user", "q"), ("assistant", "a")] for i in range(1, 6)}
    assert {r.conv_id for r in chat.unknown_layouts(df, "i", "j").collect()} == {6, 7, 8, 9}
    nested = spark.sql("SELECT 1 AS id, array(named_struct('role', 'user', 'content', 'q'), named_struct('role', 'assistant', 'content', CAST(NULL AS STRING))) AS messages, 'x' AS turn")
    assert [tuple(r) for r in chat.from_table(nested).orderBy("turn").collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.from_table(spark.range(1).toDF("what"))


def test_chat_digest(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (1, 2, "assistant", "### </turn>\n\\"), (None, None, None, "z"), (2, 0, "assistant", "a" * 50000), (2, 0, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"piece": F.lit(1), "id": F.lit("i"), "loss_start": F.lit(None).cast("string")})
    got = {r.conv_id: r for r in chat.digest(chat.render(chat.from_table(df), together=True)).collect()}
    for conv in (1, 2, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].loss_chars == len(loss) and got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
    assert chat.digest(chat.render(df.where("false"), together=True)).count() == 0 and chat.render(df.where("false")).count() == 0


def test_chat_layouts_are_found_by_hash(spark):
    def record(paths):
        out = {}
        for p in paths:
            at, *names = p.split(".") if "[]" not in p else (p.split("[]")[0], p.split("[].")[1])
            if "[]" in p:
                out.setdefault(at, [{}])[0][names[0]] = "x"
            elif names:
                out.setdefault(at, {})[names[0]] = "x"
            else:
                out[at] = "x"
        return out

    find = chat.Layouts().find
    for layout in chat.LAYOUTS:
        for id in (True, False):
            r = record(layout.paths(id))
            assert chat.record_paths(r) == set(layout.paths(id)) and find(chat.record_paths(r)) == ("all", layout)
            frame = spark.read.json(spark.sparkContext.parallelize([json.dumps(r)]))
            assert find(chat.schema_paths(frame.schema)) == ("all", layout)
            assert find(chat.record_paths(r | {"made": 1, "tags": ["a"]})) == ("fields", layout)
    assert find({"id", "messages[].role", "messages[].content", "prompt"}) == ("parts", chat.LAYOUTS[1]) and find({"what"}) == ("none", None)


def test_chat_long_conversation_is_split(spark):
    rows = spark.range(4000).selectExpr("1L as conv_id", "id as turn", "'user' as role", "concat('t', id) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are put together
    try:
        parts = chat.render(rows).select(F.spark_partition_id().alias("p"), "piece").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({p.p for p in parts}) > 1 and "".join(p.piece for p in sorted(parts, key=lambda p: p.p)) == "".join(chat.render_turn("user", f"t{i}")[0] for i in range(4000))


# ---- token files


def test_simple8b_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 5, 1023, 1024, 1025, 9000):
        for high in (1, 2, 300, 50_000, 1 << 40, 1 << 63):
            ids = r.integers(0, high, n, dtype=np.uint64)
            ids[r.integers(0, max(n, 1), n // 2)] = 0
            assert (token_file.decode_blocks(*token_file.encode_blocks(ids), n) == ids).all()
    got = token_file.unpack(token_file.pack([None, 7], [2, 1], np.array([5, 2, 2], np.uint64)))
    assert got[0] == [None, 7] and got[1].tolist() == [2, 1] and got[2].tolist() == [5, 2, 2]
    with pytest.raises(ValueError):
        token_file.unpack(b"x" * 80)


def test_token_file_rows(spark, odd, empty, tmp_path):
    from tokenizers import Tokenizer

    path = token_file.vocabulary()
    library = Tokenizer.from_file(path)
    token_file.write(odd.select("doc_id", "text"), path, str(tmp_path / "a"), file_ids=50)
    got = token_file.read(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 2, 3, 4, 5, 6]
    start, texts = 0, dict(ODD)
    for r in got:
        ids = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    token_file.write(empty, path, str(tmp_path / "b"))
    assert token_file.read(spark, str(tmp_path / "b")).count() == 0


def test_byte_level_encoder_is_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(token_file.vocabulary()), token_file.encoder(token_file.vocabulary())
    r = random.Random(2)
    parts = ["word", " ", "  ", "\n", " \n", "\t", "'s", "don't", "12,5", "é", "日本", "😀", "<|endoftext|>", "!!", "A.", "\xa0", "\x0b", "&&&"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(3000)] + ["", " ", " a", "a "]
    assert [g.tolist() for g in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


# ---- streaming BPE


def test_stream_bpe_is_the_library():
    from tokenizers import Tokenizer

    path = stream_bpe.vocabulary()
    library, own = Tokenizer.from_file(path), stream_bpe.encoder(path)
    r = random.Random(3)
    parts = ["word", " ", "\n", "'S", "don't", "12", "é", "e\u0301", "日本", "😀", "<|endoftext|>", "<|startoftext|>", "!!", "ΑΣ", "İ", "<|end", "\xa0", "ß"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(2000)] + ["", "th" * 3000, "a" * 4001, "".join(r.choice("thernaiousl") for _ in range(9000))]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert stream_bpe.digest(own, t) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_lookahead_is_enough():
    """Over random merge lists, what comes before the end stays whatever follows, and what is held is within the bound."""
    r, early = random.Random(4), 0
    for _ in range(300):
        tokens, merges = list("abc"), []
        for _ in range(r.randrange(1, 9)):
            pair = (r.choice(tokens), r.choice(tokens))
            if pair not in merges:
                merges.append(pair)
                tokens.append("".join(pair))
        m = stream_bpe.MergeList(merges)
        for _ in range(20):
            word = [r.choice("abc") for _ in range(r.randrange(1, 60))]
            t, got = stream_bpe.Transducer(m), []
            for c in word:
                got += t.push([c])
                assert len(t.held) <= t.bound
            early += len(got)
            assert [*got, *t.finish()] == m.apply(list(word)), (merges, word)
    assert early > 10_000


def test_words_end_apart_from_their_middles():
    """Over random merge lists with a suffix at the end of words."""
    r = random.Random(6)
    for _ in range(200):
        middle, ends, merges = list("abc"), ["a_", "b_", "c_"], []
        for _ in range(r.randrange(1, 12)):
            pair = (r.choice(middle), r.choice(middle + ends))
            if pair not in merges:
                merges.append(pair)
                (ends if pair[1].endswith("_") else middle).append("".join(pair))
        t = stream_bpe.Transducer(stream_bpe.MergeList(merges, "_"))
        for _ in range(20):
            word = [r.choice("abc") for _ in range(r.randrange(1, 30))]
            assert t.word(word) == t.merges.apply([*word[:-1], word[-1] + "_"]), (merges, word)
    assert t.word([]) == []


def test_tokens_come_before_ordinary_words_end(spark):
    """Of the words of a whole table tokens come before the end, and with no lookahead at all the ids would be wrong."""
    import pyarrow.parquet as pq

    own = stream_bpe.WordBpe(stream_bpe.vocabulary())

    class Hasty(stream_bpe.Transducer):
        def _place(self, *state):
            found, still = super()._place(*state)
            return found, still[-1:]

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    words = sorted({w for t in texts for run in (t or "").lower().split() for w in own.words.findall(run)})
    early, wrong, hasty = 0, 0, Hasty(own.merges)
    for w in words:
        symbols = [own.letters[b] for b in w.encode()]
        t = own.transducer
        first = list(t.push(symbols))
        early += bool(first)
        tokens = [*first, *t.finish()]
        assert tokens == t.word(symbols) == own.merges.apply([*symbols[:-1], symbols[-1] + own.merges.suffix])
        hasty._start()
        try:
            wrong += hasty.word(symbols) != tokens
        except (TypeError, KeyError):
            wrong += 1
    print("different words", len(words), "with tokens before the end", early, "wrong without lookahead", wrong)
    assert early > len(words) / 10 and wrong > len(words) / 10


def test_transducer_keeps_states_and_forgets_them(monkeypatch):
    """Words that begin alike take the steps that are kept, and results stay the same when states are forgotten on the way."""
    own = stream_bpe.encoder(stream_bpe.vocabulary())
    r = random.Random(8)
    words = ["".join(r.choice(["th", "er", "ing", "ou", "n", "é", "ß"]) for _ in range(r.randrange(1, 12))) for _ in range(3000)]
    spelled = [[own.letters[b] for b in w.encode()] for w in words]
    want = [own.merges.apply([*s[:-1], s[-1] + own.merges.suffix]) for s in spelled]
    t, steps = stream_bpe.Transducer(own.merges), []
    monkeypatch.setattr(t, "_step", lambda *a, f=t._step: (steps.append(a), f(*a))[1])
    assert [t.word(s) for s in spelled] == want and len(steps) < sum(map(len, spelled)) / 2
    once = len(steps)
    assert [t.word(s) for s in spelled] == want and len(steps) == once
    monkeypatch.setattr(stream_bpe, "STATE_SYMBOLS", 500)
    assert [t.word(s) for s in [*spelled, ["q", *"th" * 9]]][:-1] == want and t.kept <= 500 + 64 + stream_bpe.STATE_COST
    # pairs are told apart as by the merges, where several merges make one token, too
    for _ in range(300):
        tokens, merges = list("ab"), []
        for _ in range(r.randrange(1, 8)):
            merges.append((r.choice(tokens), r.choice(tokens)))
            tokens.append("".join(merges[-1]))
        m = stream_bpe.MergeList(merges)
        for a in set(tokens):
            for b in set(tokens):
                assert not m.made[a, False] or m.together[a, b, False] == (m.apply([*a, *b]) == [a, b]), (merges, a, b)


def test_every_word_goes_through_the_transducer(monkeypatch):
    passed = []
    for name in ("word", "push"):
        plain = getattr(stream_bpe.Transducer, name)
        monkeypatch.setattr(stream_bpe.Transducer, name, lambda self, symbols, f=plain: f(self, passed.append(held := list(symbols)) or held))
    own = stream_bpe.WordBpe(stream_bpe.vocabulary())
    short = "it's a test of 12 words, don't skip any!"
    list(own.encode(short + " é日本 " + "x" * 300))
    back = {b: c for b, c in enumerate(own.letters)}
    want = {"".join(back[b] for b in w.encode()) for run in (short.split() + ["é日本", "x" * 300]) for w in own.words.findall(run)}
    assert want <= {"".join(p) for p in passed}


def test_tokens_come_before_a_long_word_ends():
    own = stream_bpe.encoder(stream_bpe.vocabulary())
    t = stream_bpe.Transducer(own.merges)
    for text in ("thernaiousl" * 900, "a" * 5000, "=" * 5000, "ha" * 3000):
        symbols, got, most = [own.letters[b] for b in text.encode()], 0, 0
        for i, c in enumerate(symbols):
            got += len(list(t.push([c])))
            most = max(most, len(t.held))
            assert i <= t.bound or got  # the first tokens come at the latest when the bound is reached
        list(t.finish())
        assert got > 50 and most <= t.bound < 1300, (text[:20], got, most)


def test_decoder_holds_unfinished_characters():
    raw = dict(enumerate(bytes([b]) for b in "é😀".encode()))
    out = stream_bpe.TextDecoder(raw)
    assert "".join(out.push([i]) for i in raw) + out.finish() == "é😀" and stream_bpe.TextDecoder(raw).push([0]) == ""


def test_stream_bpe_rows(odd, empty):
    got = stream_bpe.encode(odd, stream_bpe.vocabulary()).collect()
    assert len(got) == len(ODD) and all(r.n_tokens == len(r.ids) for r in got)
    assert {r.doc_id: r.n_tokens for r in got}[3] == 0 and stream_bpe.digests(empty, stream_bpe.vocabulary()).count() == 0


# ---- piece counts


def test_automaton_is_greedy():
    def greedy(w, first, later):
        i = n = 0
        while i < len(w):
            j = next((j for j in range(len(w), i, -1) if w[i:j] in (first if i == 0 else later)), None)
            if j is None:
                return -1
            i, n = j, n + 1
        return n

    r = random.Random(5)
    for _ in range(800):
        first, later = ({"".join(r.choice("ab") for _ in range(r.randrange(1, 5))) for _ in range(8)} for _ in range(2))
        a = piece_counts.Automaton(first, later)
        for _ in range(10):
            w = "".join(r.choice("abc") for _ in range(r.randrange(1, 12)))
            assert a.count(w) == greedy(w, first, later)


def test_piece_count_rows(odd, empty, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("a\nb\nlo\n##ne\nx\nw\n")
    got = {r.doc_id: tuple(r)[1:] for r in piece_counts.counts(odd, str(path)).collect()}
    assert got[1] == (5, 5, 3) and got[2] == got[3] == (0, 0, 0) and got[4] == (1, 2, 0) and got[5] == (3000, 3000, 0) and got[None] == (3, 3, 2)
    assert piece_counts.counts(empty, str(path)).count() == 0


# ---- simhash


def test_trie_join_is_all_pairs():
    r = np.random.default_rng(6)
    fps = np.unique(np.concatenate([r.integers(0, 1 << 63, 60, dtype=np.uint64), *(np.uint64(int(b)) ^ (np.uint64(1) << r.integers(0, 64, 25).astype(np.uint64)) for b in r.integers(0, 1 << 62, 12))]))
    group = np.zeros(len(fps), np.int64)
    for budget in (0, 2, 4, 9):
        got = set()
        simhash.trie_pairs(group, fps, budget, lambda i, j: got.update(zip(i.tolist(), j.tolist())))
        assert got == {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= budget}


@pytest.mark.parametrize("group_rows", [50_000, 7])
def test_links_keep_components(spark, group_rows):
    r = random.Random(7)
    seeds = [r.getrandbits(64) for _ in range(30)]
    fps = list({s ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for s in seeds for _ in range(12)} | {0})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    root = {f: f for f in signed}
    for u, v in ((a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4):
        a, b = root[signed[u]], root[signed[v]]
        if a != b:
            root = {k: min(a, b) if x in (a, b) else x for k, x in root.items()}
    got = {x.node: x.root for x in simhash.components(simhash.links(df, 4, group_rows)).collect()}
    assert {f: got.get(f, f) for f in signed} == root


def test_batches_run_without_a_search_for_cycles(spark):
    import gc

    from tidemark.llm.common import map_rows, uncollected

    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    got = map_rows(df, lambda b: {"doc_id": b.column(0), "on": [gc.isenabled()] * b.num_rows}, "doc_id long, on boolean").collect()
    assert len(got) == 2 and not any(r.on for r in got)
    with pytest.raises(KeyError), uncollected():
        raise KeyError
    assert gc.isenabled()


def test_forgotten_states_hold_no_others():
    one = stream_bpe.Transducer(stream_bpe.MergeList([("a", "b"), ("ab", "c"), ("b", "c")]))
    words = ["abcabc", "bcab", "cabcabcb", "aabbcc"]
    want = [one.word(w) for w in words]
    states = list(one.states.values())
    assert any(s.on for s in states)
    one._forget()
    assert not any(s.on for s in states) and [one.word(w) for w in words] == want


def test_components_of_stars_take_no_round(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(simhash, "settled", lambda df, own=simhash.settled: kept.append(df) or own(df))
    links = [(5, 1), (1, 7), (9, 1), (20, 30), (5, 1), (4, 4)]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {5: 1, 7: 1, 9: 1, 30: 20} and len(kept) == 1
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(70 + i, 69) for i in range(300)], "u long, v long")
    df = simhash.components(chain)
    got = {x.node: x.root for x in df.collect()}
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 60  # the planner's guess
    assert got == {i: 0 for i in range(1, 61)} | {70 + i: 69 for i in range(300)}
    assert not simhash.stars(spark.createDataFrame([(2, 1), (3, 2)], "u long, v long")) and not simhash.stars(spark.createDataFrame([(3, 1), (3, 2)], "u long, v long"))


def test_hot_and_even_keys_join_alike(spark):
    from tidemark.llm.common import join_hot

    for n in (3, 400):  # the most frequent key has all but a few of the rows, or none has more than the others
        rows = spark.range(1200).selectExpr("if(id < 800 or {0} > 3, id % {0}, 0) key".format(n), "id")
        by_key = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        want = sorted(tuple(x) for x in rows.join(by_key, "key").select("key", "id", "last").collect())
        assert sorted(tuple(x) for x in join_hot(rows, by_key, "key", "n").select("key", "id", "last").collect()) == want


def test_simhash_rows(spark, odd, empty):
    def fp(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    rows = simhash.near_duplicates(odd).collect()
    assert sorted((r.doc_id or -1, r.fp % (1 << 64)) for r in rows) == sorted((i or -1, fp(t)) for i, t in ODD)
    ids = {r.doc_id: r.component_id for r in rows}
    assert ids[2] == ids[3] == 2 and ids[1] == 1 and ids[None] is None
    assert simhash.near_duplicates(empty).count() == 0


def test_near_copies_are_all_pairs(spark, odd, empty):
    import corpus_pipeline as pipe
    from tidemark.llm import copies

    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [r.choice(vocabulary) for _ in range(30)]  # a passage that many texts hold
    texts = []
    for _ in range(25):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 8, 60, 150]))] + common * r.randrange(2)
        for _ in range(r.randrange(2, 9)):
            w = list(base)
            for _ in range(r.randrange(3)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w) + r.choice(["", "\n"]))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "only here"), (None, "only here"), (3, "another text of the third id"), (7, None), (8, "")]
    rows += [(0, texts[0])] * 2
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for _, t in rows]
    root = list(range(len(rows)))
    near = 0
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                near += sets[a] != sets[b]
                x, y = root[a], root[b]
                root = [min(x, y) if c in (x, y) else c for c in root]
    assert near > 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {}
    for row, c in zip(rows, root):
        want.setdefault(c, set()).add(row)
    named = df.withColumn("k", copies.row_key()).distinct().select("k", "text")
    for group_rows in (copies.GROUP_ROWS, 3):  # with 3 most groups meet part by part
        got = {}
        for x in copies.near_copies(df, group_rows=group_rows).join(named, "k").collect():
            got.setdefault(x.root, set()).add((x.doc_id, x.text))
        assert sorted(map(repr, map(lambda g: sorted(g, key=repr), got.values()))) == sorted(map(repr, map(lambda g: sorted(g, key=repr), want.values())))
    kept = [(x.doc_id, x.text) for x in pipe.drop_near_duplicates(spark, df, "").collect()]
    assert len(kept) == len(want) and all(sum(k in g for k in kept) == 1 for g in want.values())
    assert all(min((i is None, i or 0) for i, _ in g) in {(i is None, i or 0) for i, t in kept if (i, t) in g} for g in want.values())
    assert pipe.drop_near_duplicates(spark, empty, "").count() == 0
    assert pipe.drop_near_duplicates(spark, odd, "").count() == 6


def test_pairs_of_one_shingle_lose_no_similar_pair():
    """Sets that share one shingle, many of them near each other: no pair that is similar is ruled out by size, place or sketch."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import copies

    rng, sets = np.random.default_rng(5), []
    for _ in range(30):
        base = rng.integers(1, 2**63, rng.choice([4, 10, 60, 200])).astype(np.uint64)
        for _ in range(6):
            own = base.copy()
            change = rng.random(len(own)) < rng.choice([0, 0.05, 0.1, 0.2])
            own[change] = rng.integers(1, 2**63, change.sum()).astype(np.uint64)
            sets.append(np.unique(np.r_[np.uint64(0), own]))
    want = set()
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if both >= copies.SIMILAR * (len(sets[a]) + len(sets[b]) - both):
                want.add((b, a))
    brief = np.array([np.bitwise_xor.reduce(copies.parities(s).reshape(-1, 2)) for s in sets])
    assert (brief < 0).any() and len(want) > 100
    k = np.arange(len(sets))
    cols = [0 * k, k, np.array([len(s) for s in sets]), 0 * k, k, brief[:, 0], brief[:, 1], 0 * k]
    rows = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=list("gtniryzs"))
    got = {(int(u), int(v)) for out in copies._pairs([rows.slice(0, 50), rows.slice(50)]) for u, v in zip(*map(lambda c: c.to_numpy(), out.columns))}
    assert want <= got and len(got) < 4 * len(want)


def test_large_sets_of_one_shingle_are_told_apart_before_they_are_dealt():
    """Large sets with only one shingle in common make no pairs, in sizes whose sketches have to be folded too; no similar pair is lost."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import copies

    rng, sets = np.random.default_rng(6), []
    for size in (120, 135, 250, 265, 500, 530, 2000, 2100):
        base = rng.integers(1, 2**63, size).astype(np.uint64)
        for share in (0, 0.01, 0.03, 0.05, 0.08, 0.2):
            own = base.copy()
            change = rng.random(len(own)) < share
            own[change] = rng.integers(1, 2**63, change.sum()).astype(np.uint64)
            sets.append(np.unique(np.r_[np.uint64(0), own[: size - rng.integers(8)]]))
    k = np.arange(len(sets))
    both = np.array([[len(np.intersect1d(a, b)) for a in sets] for b in sets])
    sizes = np.array([len(s) for s in sets])
    want = {(a, b) for a, b in np.argwhere(both >= copies.SIMILAR * (sizes[:, None] + sizes - both)).tolist() if a < b}
    x = [copies.parities(s) for s in sets]
    brief = np.array([np.bitwise_xor.reduce(c.reshape(-1, 2)) for c in x])
    cells = pa.array([copies.sketch(c, n) for c, n in zip(x, sizes.tolist())], pa.list_(pa.int64()))
    cols = [0 * k, k, sizes, 0 * k, k, brief[:, 0], brief[:, 1], 0 * k]
    rows = pa.RecordBatch.from_arrays([*map(pa.array, cols), cells], names=list("gtniryzsx"))
    read = lambda rows: {(int(u), int(v)) for out in copies._pairs(rows) for u, v in zip(*map(lambda c: c.to_numpy(), out.columns))}
    got, without = read([rows.slice(0, 20), rows.slice(20)]), read([rows.select(list("gtniryzs"))])
    assert len(want) > 50 and want <= got and len(got) < 2 * len(want)
    assert len({(a, b) for a, b in without if a // 6 != b // 6}) > 50 and not {(a, b) for a, b in got if a // 6 != b // 6}


def test_near_copies_of_one_group_write_fewer_links_than_rows():
    """Sets whose pairs are as many as their square: what tasks write stays below their number and connects what all pairs do."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import copies

    rng, sets = np.random.default_rng(7), []
    base = rng.integers(1, 2**63, 150).astype(np.uint64)
    for _ in range(200):
        own = base.copy()
        change = rng.random(len(own)) < 0.1
        own[change] = rng.integers(1, 2**63, change.sum()).astype(np.uint64)
        sets.append(np.unique(np.r_[np.uint64(0), own]))
    k, sizes = np.arange(len(sets)), np.array([len(s) for s in sets])

    def parts(links):
        root = list(range(len(sets)))
        for u, v in links:
            a, b = root[u], root[v]
            root = [min(a, b) if c in (a, b) else c for c in root]
        return root

    read = lambda found: [(int(u), int(v)) for out in found for u, v in zip(*map(lambda c: c.to_numpy(), out.columns))]
    brief = np.array([np.bitwise_xor.reduce(copies.parities(s).reshape(-1, 2)) for s in sets])
    cols = [0 * k, k, sizes, 0 * k, k, brief[:, 0], brief[:, 1], 0 * k]
    rows = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=list("gtniryzs"))
    pairs, chains = read(copies._pairs([rows])), read(copies._chains([rows]))
    assert len(pairs) > 10 * len(sets) > 10 * len(chains) and parts(pairs) == parts(chains)
    both = np.array([[len(np.intersect1d(a, b)) for a in sets] for b in sets])
    similar = np.argwhere(both >= copies.SIMILAR * (sizes[:, None] + sizes - both))
    shingled = pa.RecordBatch.from_arrays([*(pa.array(c) for c in (0 * k, k, k, 0 * k)), pa.array([s.view(np.int64) for s in sets])], names=["g", "t", "root", "side", "s"])
    links = read(copies._linked([shingled.slice(0, 70), shingled.slice(70)]))
    assert len(links) < len(sets) and parts(links) == parts(similar)


# ---- personal data


def base_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if 2 * int(c) > 9 else 2 * int(c)) for i, c in enumerate(d[::-1])) % 10 == 0

    rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for k, rule in rules.items():
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (k == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (k == "card" and not (13 <= len(d) <= 19 and luhn(d))) or (k == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append(f"{k}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark):
    r = random.Random(8)
    parts = ["a@b.c", "_", "@", ".", "x", "1.2.3.4", "300", "0001", "+", "1 (523) 555-1055", "4785380592391139", "4111 1111-1111 1111", " ", "-", "9" * 5, "é", "😀", "(", "%", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(600)]
    texts += [None, "", "1" * 5000 + " a" + "b" * 5000 + "@c.d", "+1" + "(" * 2000 + " 1 2 3" * 500]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "mail x@y.zz now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h": F.lit("x"), "kind": F.lit(1), "start": F.lit(2)})
    got = pii.summary(df, pii.spans(df)).collect()
    assert len(got) == len(rows)
    for x in got:
        want = base_spans(dict(rows)[x.doc_id])
        assert x.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= {*x.spans.split(","), ""}
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.BASE]
    clean = pii.redact(df, pii.spans(df))
    assert clean.columns == df.columns and clean.count() == len(rows)
    assert {c.text for c in clean.where("doc_id is null").collect()} == {"mail [EMAIL] now"}
    none = df.where("false")
    assert pii.summary(none, pii.spans(none)).count() == 0


def planted(n, seed=5):
    """Texts with further kinds of personal data and things that look like them, and the true spans."""
    r = random.Random(seed)
    names, last = pii.GIVEN_NAMES.split(), ["Meyer", "Smith", "Laurent", "Garcia", "Okafor", "Rossi"]
    unlisted = ["Zoltan", "Ingrid", "Thabo", "Yusra"]
    assert not {*unlisted} & {*names}
    hexed = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    true = {
        "secret": lambda: r.choice(["token", "api_key", "secret", "db_password", "auth-token"]) + r.choice([" = ", "=", ": "]) + '"' + hexed(40) + '"',
        "name": lambda: r.choice([f"{r.choice(names)} {r.choice(last)}", f"{r.choice(['Mr', 'Dr.', 'Frau'])} {r.choice(names)} {r.choice(last)}", f"{r.choice(['Mr', 'Dr.', 'Frau'])} {r.choice(unlisted)} {r.choice(last)}"]),
        "ssn": lambda: f"{r.choice(['ssn ', 'social '])}|{r.randrange(100, 660)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}",
        "local_phone": lambda: f"{r.choice(['call ', 'tel ', 'phone '])}|({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}",
        "masked_email": lambda: f"{r.choice(['mail ', 'contact '])}|{hexed(5)}x (at) {hexed(4)}y (dot) {r.choice(['com', 'org', 'de'])}",
    }
    false = [lambda: f'commit = "{hexed(40)}"', lambda: f"sha: {hexed(64)}", lambda: 'class="' + "a" * 20 + '"', lambda: f"000-00-{r.randrange(1000, 9999)}", lambda: f"no. 100 000-{r.randrange(1000, 9999)}#", lambda: f"done. {r.choice(['Green', 'Paper', 'Under'])} {r.choice(['Table', 'Water', 'Lines'])}"]
    filler = "the report of last week was read by all and nothing in it was new to them".split()
    rows, spans = [], set()
    for i in range(n):
        text = ""
        for _ in range(r.randrange(1, 6)):
            text += " ".join(r.choice(filler) for _ in range(r.randrange(3, 12))) + " "
            if r.random() < 0.6:
                kind = r.choice(list(true))
                lead, _, span = true[kind]().rpartition("|")
                text += lead
                spans.add((i, kind, len(text), len(text) + len(span)))
                text += span + ", "
            else:
                text += r.choice(false)() + ", "
        rows.append((i, text))
    return rows, spans


def test_pii_further_kinds_precision_and_recall(spark):
    rows, want = planted(600)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(x.doc_id, x.kind, x.start, x.end) for x in pii.spans(df).where("not base").collect()}
    print("further kinds: precision", len(found & want) / len(found), "recall", len(found & want) / len(want))
    assert len(found & want) / len(found) >= 0.9 and len(found & want) / len(want) >= 0.9
    # no labeler says the same of all proposals of a kind, but where it has nothing to say
    votes = pii.occurrences(df).select("kind", F.explode(pii.votes(*map(F.col, ("kind", "m", "left", "right")))).alias("v"))
    assert votes.where("kind in ('name', 'secret')").groupBy("kind", "v").count().groupBy("kind").count().where("count >= 2").count() == 2
    for j in (1, 2, 3):  # gazetteer, words before, signs against
        own = pii.occurrences(df).select("kind", pii.votes(*map(F.col, ("kind", "m", "left", "right")))[j].alias("v")).where("kind in ('name', 'secret')").distinct().groupBy("kind").count()
        assert {x.kind: x["count"] for x in own.collect()}["name"] >= 2


def test_pii_redact_is_brute_force(spark):
    r = random.Random(6)
    long = "".join(r.choice(["é ", "😀", "a@b.cc ", "word ", "1.2.3.4, ", "\n"]) for _ in range(9000))
    rows = [(1, long), (2, "a@b.cc"), (3, "x" * pii.BLOCK + " a@b.cc"), (4, " " * (pii.BLOCK - 3) + "a@b.cc" + " " * (2 * pii.BLOCK)), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.text for x in pii.redact(df, pii.spans(df)).collect()}
    for i, t in rows:
        cuts = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in base_spans(t)))
        want, at = "", 0
        for a, b, k in cuts:
            want += (t or "")[at:a] + f"[{k.upper()}]"
            at = b
        assert got[i] == (t if not cuts else want + t[at:])


def test_pii_learns_further_kinds(spark):
    rows = [(i, f'then token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and mail a{i}@b.org, 10.0.0.{i % 200}') for i in range(120)]
    found = pii.spans(spark.createDataFrame(rows, "doc_id long, text string"))
    kinds = {r.kind: r["count"] for r in found.groupBy("kind").count().collect()}
    assert kinds["email"] == kinds["ip"] == 120 and kinds["secret"] >= 110


# ---- decontamination


def template_by_hand(text, capitals):
    """The words' keys and what stands in slots, by the module's rules for ASCII text without marks inside numbers."""
    before = r"(?<![A-Za-z0-9])" if capitals else r"(?<=[a-z,;] )"
    marked = re.sub(rf"{before}([A-Z])(?=[a-z])", "~\\1", text)
    out = []
    for w in re.findall(r"[a-z0-9~]+", marked.lower()):
        kind = "NAME" if w[0] == "~" else "NUMBER" if w[0].isdigit() or w in decontaminate.NUMBER_WORDS.split() else "UNIT" if w in decontaminate.UNITS.split() else None
        out.append((kind or w, w if kind else None))
    return out


def found_by_hand(docs, items):
    """Brute force over all alignments: {(doc_id, item_id)}."""
    out = set()
    for item_id, item in items:
        for doc_id, doc in docs:
            for capitals in (False, True):
                a, b = template_by_hand(item or "", capitals), template_by_hand(doc or "", capitals)
                telling = [i for i in range(len(a) - 4) if sum(v is None for _, v in a[i : i + 5]) >= 2]
                met = set()
                for shift in range(-len(a), len(b)):
                    own = [i for i in telling if 0 <= i + shift <= len(b) - 5 and all(a[i + k][0] == b[i + shift + k][0] for k in range(5))]
                    pairs = {(a[i + k][1], b[i + shift + k][1]) for i in own for k in (0, 4) if a[i + k][1] is not None}
                    if len({x for x, _ in pairs}) == len(pairs):
                        met |= {*own}
                if telling and len(met) >= 0.8 * len(telling):
                    out.add((doc_id, item_id))
    return out


def test_decontamination_is_brute_force_and_loses_no_shared_ids(spark):
    a, b = "the small grey cat sat on the old mat in a warm room", "every morning Anna takes 3 books to the large town library and reads"
    shared = [(1, a), (2, b)], [(1, a), (1, b)], [(None, a), (None, b)]
    docs = [(10, "xx " + a + " yy"), (11, "so every morning Maria takes 7 books to the large town library and reads ok"), (None, "and " + a), (12, "nothing here"), (12, a), (13, a[:40]), (14, None)]
    for items in shared:
        d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(d, i).collect()}
        assert got == found_by_hand(docs, items) and {x for x, _ in got} == {10, 11, 12, None}
    r = random.Random(12)
    words = "Anna Bob took 3 7 kg miles of red apples to the shop and paid for them in two days while it was cold".split()
    items = [(r.randrange(6), " ".join(r.choice(words) for _ in range(r.randrange(8, 14)))) for _ in range(12)]
    docs = []
    for n in range(60):
        text = r.choice(items)[1].split() if r.random() < 0.7 else [r.choice(words) for _ in range(10)]
        text = [r.choice(["Carl", "Anna"]) if w == "Anna" and r.random() < 0.4 else r.choice("3579") if w.isdigit() and r.random() < 0.5 else r.choice(words) if r.random() < 0.04 else w for w in text]
        docs.append((n % 40, " ".join([r.choice(words) for _ in range(r.randrange(3))] + text)))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(d, i).collect()}
    bare = {k for k, t in items if not any(sum(v is None for _, v in template_by_hand(t, c)[j : j + 5]) >= 2 for c in (False, True) for j in range(len(t.split()) - 4))}
    assert {x for x in got if x[1] not in bare} == {x for x in found_by_hand(docs, items) if x[1] not in bare} and len(got) > 20


def test_decontamination(spark):
    items = [(1, "Then Alice bought 3 kg of red apples and paid 7 dollars, but Alice kept 3 kg for later use at home"), (2, "few words"), (3, None), (4, "1 2 3 4 5 6 7 8"), (5, "the small grey cat sat on the old mat in a warm room all day long")]
    docs = [
        (1, "xx yy zz so then Bob bought 5 kg of red apples and paid 9 dollars, but Bob kept 5 kg for later use at home ok"),
        (2, "so then Bob bought 5 kg of red apples and paid 9 dollars, but Eve kept 8 kg for later use at home ok"),
        (3, None),
        (4, ""),
        (5, "9 8 7 6 5 4 3 2 1 0 too few words"),
        (6, "word " * 5000 + "THE SMALL GREY CAT SAT ON THE OLD MAT IN A WARM ROOM ALL DAY LONG"),
        (7, "the small grey cat sat on the old mat"),
        (None, "the small grey cat sat on the old mat in a warm room all day long"),
        (6, "word " * 5000 + "THE SMALL GREY CAT SAT ON THE OLD MAT IN A WARM ROOM ALL DAY LONG"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"key": F.lit(1), "item_id": F.lit(9), "pos": F.lit("p")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(2))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, i).collect()}
    assert got == {(1, 1), (6, 5), (None, 5)}
    assert decontaminate.contaminated(d.where("false"), i).count() == 0 == decontaminate.contaminated(d, i.where("false")).count()


def test_decontamination_tells_names_that_start_a_sentence(spark):
    items = [
        (1, "Tom has 5 apples. Tom gives 2 apples to Mary. Mary buys 3 more apples. How many apples does Mary have now?"),
        (2, 'In 2009 Élodie sold 12 hats. "Élodie sold fewer," said the clerk (Karl). Karl counted 7 hats. Élodie then gave 4 hats to Karl. How many hats were left in the shop?'),
    ]
    docs = [
        (1, "Intro.\nJohn has 7 apples. John gives 4 apples to Susan. Susan buys 9 more apples. How many apples does Susan have now? End."),
        (2, "John has 7 apples. Peter gives 4 apples to Susan. Laura buys 9 more apples. How many apples does Emma have now?"),
        (3, 'In 1999 Zoé sold 15 hats. "Zoé sold fewer," said the clerk (Udo). Udo counted 8 hats. Zoé then gave 6 hats to Udo. How many hats were left in the shop?'),
        (5, "John has 7 pears. John eats 4 plums with Susan. Susan sells 9 more nuts. How many nuts does Susan want now?"),
        (1, "Here is a clean text of the first id, about apples that nobody has."),
    ]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, i).collect()]
    assert sorted(got) == [(1, 1), (3, 2)]


def test_template_words(spark):
    text = "Then Alice bought 3.5 kg, and 12 apples for two dollars. Bob's a1 x\nThe end"
    got = spark.createDataFrame([(text,)], "t string").select(decontaminate.template_words(F.col("t"))).first()[0]
    assert got == ["then", "\ue001alice", "bought", "3.5", "kg", "and", "12", "apples", "for", "two", "dollars", "bob", "s", "a1", "x", "the", "end"]


def reworded(n, seed=9):
    """Questions with slots, each filled twice with other names, numbers and units; every third is short."""
    r = random.Random(seed)
    nouns = [a + b for a in "apple pear brick stone shell coin stamp ticket pencil bottle".split() for b in ("s", "boxes", "bags", "rows")]
    verbs = "gives sells lends sends brings shows throws hands passes offers".split()
    names = "Tom Mary John Susan Karl Laura Peter Emma Hugo Nora Felix Ida Otto Vera".split()
    units = [("kg", "mg"), ("miles", "km"), ("hours", "minutes"), ("dollars", "euros")]
    forms = [
        "{a} has {x} {n}. {a} {v} {y} of the {n} to {b}. Then {b} {w} {z} {n} more. How many {n} does {b} have in the end?",
        "In {x} days a farm needs {y} {u} of {n}, and {a} {v} {z} {u} every week. After how long must {b} buy new {n}?",
        "If {a} {v} {x} {n} for {y} {u}, what does {b} pay for {z} such {n}?",
        "How many {n} are in {x} {u}?",
        "Add {x} {n} and {y} {m}",
    ]
    pairs = []
    for i in range(n):
        fixed = dict(n=r.choice(nouns), m=r.choice(nouns), v=r.choice(verbs), w=r.choice(verbs), k=r.choice(units))
        out = []
        for k in (0, 1):
            a, b = r.sample(names, 2)
            x, y, z = (str(q) for q in r.sample(range(2, 900), 3))
            out.append(forms[i % 5].format(a=a, b=b, x=x, y=y, z=z, u=fixed["k"][k], **{q: fixed[q] for q in "nmvw"}))
        pairs.append(tuple(out))
    return pairs


def test_decontamination_recall_on_reworded_items(spark):
    pairs, r = reworded(100), random.Random(3)
    filler = "the report of last week was read by all and nothing in it was new to them so they went home".split()
    talk = lambda: " ".join(r.choice(filler) for _ in range(r.randrange(5, 60)))
    docs = [(i, f"{talk()}. {b} {talk()}") for i, (_, b) in enumerate(pairs)] + [(1000 + i, talk()) for i in range(100)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(pairs)] + [(5000, "1, 2, 3, 4, 5, 6, 7, 8")], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(d, i).collect()}
    own = {(k, k) for k in range(100)}
    print("reworded items: recall", len(got & own) / 100, "clean documents found", len({a for a, _ in got if a >= 1000}))
    assert len(got & own) >= 90 and not any(a >= 1000 for a, _ in got)
    digits = spark.createDataFrame([(1, "count 1, 2, 3, 4, 5, 6, 7, 8 up"), (2, "count 2, 3, 4, 5, 6, 7, 8, 9 up")], "doc_id long, text string")
    assert [(x.doc_id, x.item_id) for x in decontaminate.contaminated(digits, i).collect()] == [(1, 5000)]


def test_windows_are_brute_force(spark):
    """Keys of windows are equal just where templates written out here are."""
    text = "Tom has 5 apples, and Mary has 7 kg. The 3 and 4 or 9 are two"
    words = [("C", "tom"), "has", ("#", "5"), "apples", "and", ("N", "mary"), "has", ("#", "7"), ("U", "kg"), ("C", "the"), ("#", "3"), "and", ("#", "4"), "or", ("#", "9"), "are", ("#", "two")]
    for capitals, slots in ((False, "N#U"), (True, "NC#U")):
        want = {}
        for pos in range(len(words) - 4):
            w = words[pos : pos + 5]
            form = tuple(("N" if x[0] in "NC" else x[0]) if isinstance(x, tuple) and x[0] in slots else x[1] if isinstance(x, tuple) else x for x in w)
            want[pos] = form, sum(not (isinstance(x, tuple) and x[0] in slots) for x in w)
        rows = decontaminate.windows(spark.createDataFrame([(1, text)], "i long, t string"), "i", "t", ("i", "pos", "a", "b"), capitals=capitals).collect()
        got = {x.pos: (x.key, x.literals) for x in rows}
        assert set(got) == set(want) and all(got[p][1] == want[p][1] for p in got)
        assert all((got[p][0] == got[q][0]) == (want[p][0] == want[q][0]) for p in got for q in got)
