"""Operators on runs, conversations and repeated strings against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic, repair, suffix

SF = "/root/testdata/sf0.001"


# ---- periodic runs


def runs_by_hand(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            s = w[i : j + q]
            if len(s) >= max(least, times * q) and not any(s[d:] == s[:-d] for d in range(1, q)):
                out.append((i, len(s), q))
            i = max(j, i + 1)
    return sorted(out)


def repetitive(r, n):
    w, k = [], r.choice([1, 2, 3, 6])
    while len(w) < n:
        u = [r.randrange(k) for _ in range(r.randint(1, 12))]
        w += u * r.randint(1, 8) + u[: r.randrange(len(u))] if r.random() < 0.5 else [r.randrange(k) for _ in range(r.randint(1, 9))]
    return w


def test_runs_are_brute_force():
    r = random.Random(1)
    for _ in range(800):
        w = repetitive(r, r.randint(0, 120))
        least = r.choice([24, 6, 9])
        ids = np.unique(np.array(w, np.int64), return_inverse=True)[1]
        assert periodic.runs(ids, least) == runs_by_hand(w, least)
        if w:
            for heavy in (1, 3, None):
                m = periodic.matches(ids, len(w) // 2, heavy)
                assert m[1:].tolist() == [sum(a == b for a, b in zip(w, w[q:])) for q in range(1, len(w) // 2 + 1)]


def test_runs_of_a_word_that_fills_a_text_need_no_quadratic_scan():
    ids = np.concatenate([np.zeros(60_000, np.int64), np.arange(1, 20_001)])
    assert periodic.runs(ids) == [(0, 60_000, 1)]
    assert periodic.runs(np.tile(np.arange(7), 9000)) == [(0, 63_000, 7)]


def test_periodic_query_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {x.doc_id: x for x in periodic.query(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w, h = re.findall(r"[^\x20\x09-\x0D]+", d.text or ""), zlib.crc32(str(d.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs, x = runs_by_hand(w), got[d.doc_id]
        some += bool(runs)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = max(runs, key=lambda k: (Fraction(k[1], k[2]), -k[0], -k[2]), default=(None,) * 3)
        assert (x.n_runs, x.start, x.length, x.period) == (len(runs), *best)
        assert x.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert x.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % k for k in runs).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(" ".join(w[i] for i in range(n) if i not in gone).encode()).hexdigest()
    assert some


def test_periodic_edges(spark):
    rows = [(1, None, 0), (1, "", 0), (None, "ab " * 40, 0), (2, " \t\n", 0), (2, "x y " * 3 + "é " * 30, 0), (2, "x y " * 3 + "é " * 30, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((x.doc_id or 0, x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in periodic.find(df).collect()), key=str)
    assert got == sorted([(1, 0, [], ""), (1, 0, [], ""), (0, 40, [(0, 40, 1)], "ab"), (2, 0, [], ""), *[(2, 33, [(3, 30, 1)], "x y x y x y é")] * 2], key=str)
    assert periodic.find(df.where("false")).count() == 0
    assert periodic.repeated(df).where("doc_id is null").first().text == "ab " * 40


# ---- conversations


def repaired_by_hand(rows):
    """The least (cost, audit) of (fault, role) rows, by Dijkstra over whole audits."""
    done, heap = set(), [(0, "", 0, repair.START)]
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (repair.START, repair.ASSISTANT):
            return cost, audit
        heapq.heappush(heap, (cost + 5, audit + "I", i, repair.ANY[state]))
        if i < len(rows):
            fault, role = rows[i]
            more = 5 * (fault == repair.BROKEN)
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            if fault != repair.GO:
                if (to := repair.KEPT.get(role[:1], {}).get(state)) is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, to))
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, repair.ANY[state]))


def test_layers_are_brute_force():
    r, layers = random.Random(2), repair.Layers()
    for _ in range(4000):
        rows = [(r.choices((repair.GO, repair.WHOLE, repair.BROKEN), (1, 5, 2))[0], r.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])) for _ in range(r.randint(0, 14))]
        assert layers.solve(bytes(repair.kind(*x) for x in rows)) == repaired_by_hand(rows)
    assert len(layers.patterns) < 100  # whatever the length


def conversation_by_hand(rows):
    """What the query returns of damaged (turn, role, text) rows in order, but for the conversation's id."""
    seen, kinds, count, blanks = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0), " \t\n\v\f\r"
    for _, role, text in rows:
        end = text.rstrip(blanks)[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        kinds.append((repair.GO if fault in ("blank", "duplicate") else repair.BROKEN if fault else repair.WHOLE, role))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    turns = {t for t, *_ in rows if t is not None}
    cost, audit = repaired_by_hand(kinds)
    state, i, lines, roles = repair.START, 0, [], {repair.USER: "user", repair.ASSISTANT: "assistant"}
    for edit in audit:
        if edit == "K":
            state = {"s": repair.SYSTEM, "u": repair.USER, "a": repair.ASSISTANT}[rows[i][1][0]]
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
        elif edit in "RI":
            state = repair.ANY[state]
            lines.append(f"{roles[state]}:{rows[i][2] if edit == 'R' else ''}")
        i += edit != "I"
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged_by_hand(conv, rows):
    out = []
    for turn, role, text in rows:
        blank = lambda x: " " if x is None else x
        code, role, text = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20, blank(role), blank(text)
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


@pytest.mark.parametrize("made", [False, True])
def test_repair_query_is_brute_force(spark, made, tmp_path):
    if made:  # nulls, blanks, ties, repeated rows, a long conversation, one that loses all its rows
        r = random.Random(4)
        text = lambda: r.choice(["a.", "b", None, "", " \n", "c!\t", "d? ", " ", "e。"])
        rows = [(r.choice([None, *range(12)]), r.choice([None, *range(9)]), r.choice(["user", "assistant", "system", "tool", None]), text()) for _ in range(500)]
        rows += [(90, i, ("user", "assistant")[i % 2], f"{i}." if r.random() < 0.9 else "again.") for i in range(3000)] + [(90, 5, "user", "5.")] * 3
        rows += [(next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "gone.")]
        spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, cost int").write.parquet(f"{tmp_path}/conversations.parquet")
    else:
        rows = [(x.conv_id, x.turn, x.role, x.text) for x in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = {x.conv_id: tuple(x)[1:] for x in repair.query(spark, str(tmp_path) if made else SF).collect()}
    assert {*got} == {x[0] for x in rows}
    for conv in got:
        own = damaged_by_hand(conv, [x[1:] for x in rows if x[0] == conv])
        said = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], said(*x[1:])))
        if len(own) > 200:  # too long for a search over audits: the layers' own answer, and the rest by hand
            assert got[conv][5] == repair.Layers().solve(bytes(_kinds(own)))[0]
        else:
            assert got[conv] == conversation_by_hand(own), conv


def _kinds(rows):
    seen = set()
    for _, role, text in rows:
        end = text.rstrip(" \t\n\v\f\r")[-1:]
        go = not end or (role, text) in seen
        seen.add((role, text))
        yield repair.kind(repair.GO if go else repair.WHOLE if end in ".!?" else repair.BROKEN, role)


def test_repaired_turns_follow_the_grammar(spark):
    rows = repair.faults(repair.damaged(spark.read.parquet(f"{SF}/conversations.parquet")))
    turns = repair.repaired(rows, repair.audits(rows)).groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "role"))), lambda x: F.left(x["role"], F.lit(1))), "").alias("roles"))
    assert turns.count() and turns.where("not roles rlike '^(s?(ua)+)?$'").count() == 0
    assert repair.audits(rows.where("false")).count() == 0


# ---- repeated strings


def test_first_owner_is_brute_force():
    r = random.Random(3)
    for _ in range(150):
        k, length = r.choice([1, 2, 3, 50]), r.choice([3, 5, 8])
        strings = [bytes(r.randrange(k) for _ in range(r.randint(length, 30))) for _ in range(r.randint(1, 12))]
        strings += [strings[0] + b"x", strings[0]]
        owners = np.array([r.randrange(100) for _ in strings])
        at, least = suffix.first_owner(strings, owners, length)
        for j, s in enumerate(strings):
            want = [min(o for o, x in zip(owners, strings) if s[i : i + length] in x) for i in range(len(s) - length + 1)]
            assert least[at[j] : at[j + 1]].tolist() == want


def test_prefixes_are_common_prefixes():
    r = random.Random(5)
    symbols = np.array([s for _ in range(9) for s in [*(r.randrange(1, 3) for _ in range(r.randint(9, 40))), 0]], np.int16)
    order, common = suffix.prefixes(symbols, 9)
    tails = [symbols[i : i + 9].tolist() for i in order]
    assert [t[: t.index(0)] if 0 in t else t for t in tails] == sorted(t[: t.index(0)] if 0 in t else t for t in tails)
    for i in range(1, len(order)):
        if 0 not in tails[i] and 0 not in tails[i - 1]:
            assert common[i] == next((k for k in range(9) if tails[i][k] != tails[i - 1][k]), 9)


def removed_by_hand(rows, length=50):
    """(kept, spans) of each (doc_id, text): null ids are last and of one kind."""
    last, first = float("inf"), {}
    docs = sorted(((last if i is None else i, (t or "").encode()) for i, t in rows), key=lambda x: x[0])
    for i, t in docs:
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], i)
    for i, t in docs:
        gone = bytearray(len(t) + 1)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        yield None if i == last else i, bytes(c for c, g in zip(t, gone) if not g), sum(gone), sum(gone[p] > gone[p - 1] for p in range(len(t)))


@pytest.mark.parametrize("block,hot", [(suffix.BLOCK, suffix.HOT), (2000, 3)])
def test_removal_is_brute_force(spark, block, hot, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", block)
    monkeypatch.setattr(suffix, "BUCKET", 4000)
    r = random.Random(6)
    line = "a line of some sixty bytes, é, that very many texts have in them"
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(20) for _ in range(6)]
    rows = [(i, r.choice([prose(5), prose(30), ""]) + r.choice([line, shared[i % 6], shared[i % 5][7:], "x" * 120, ""]) + prose(r.randint(0, 9))) for i in range(220)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (None, rows[5][1] + line), (300, None), (301, ""), (302, "ab" * 3000), (303, "y" * 49), (304, "y" * 50), (2, "y" * 51), (-5, line + "!"), (305, "é" * 400)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, kept int").repartition(5)
    got = sorted(((x.doc_id, bytes(x.kept), sum(b - a for a, b in x.removed), len(x.removed)) for x in suffix.remove_repeats(df, hot, 3000).collect()), key=str)
    want = sorted(removed_by_hand(rows), key=str)
    assert got == want
    assert suffix.remove_repeats(df.where("false")).count() == 0


def test_rows_from_blocks_to_buckets_grow_as_the_text():
    rows = lambda total: max(1, total / (suffix.BLOCK * suffix.scale(total))) * suffix.bucket_count(total)
    for small, large in ((1 << 26, 1 << 29), (1 << 29, 1 << 32)):
        assert rows(large) <= 2 * large / small * rows(small)


def test_large_blocks_and_buckets_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 1000)
    monkeypatch.setattr(suffix, "BUCKET", 500)
    monkeypatch.setattr(suffix, "PER_SCALE", 1000)
    r = random.Random(8)
    shared = ["".join(r.choice("abcd ") for _ in range(90)) for _ in range(4)]
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(r.randint(0, 99))) + r.choice(shared)[r.randint(0, 30) :]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert suffix.scale(sum(len(t) for _, t in rows)) > 3
    got = sorted((x.doc_id, bytes(x.kept)) for x in suffix.remove_repeats(df).collect())
    assert got == sorted((i, kept) for i, kept, *_ in removed_by_hand(rows))


def test_suffix_query_is_brute_force(spark):
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {x.doc_id: x for x in suffix.query(spark, SF).collect()}
    for (i, kept, n, spans), text in zip(removed_by_hand(docs), (t for _, t in sorted(docs))):
        x = got[i]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == (len((text or "").encode()), n, spans, hashlib.sha256(kept).hexdigest())
