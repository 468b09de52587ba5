"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so a question with other numbers or names keeps
its template. Windows of ``WINDOW`` template words are hash-joined between documents and benchmark
items; windows with under ``LITERALS`` words that are no placeholders say too little and take no part,
but an item that has no other windows is looked for word for word.
What stood in the slots is then compared along each alignment of an item with a document: each of the
item's values must have one value of the document's, wherever it occurs, or the alignment is dropped.
A document holds an item if at least ``SHARE`` of the item's windows are left.

A name is a word with a capital and a small letter after a lower-case letter, comma or semicolon and
a blank. That leaves out names that start a sentence or follow a figure, quote or bracket, so there is a
second template, where every word that starts with a capital and a small letter is a name; an item is
found by either, and the one that has more of its windows is reported. A number is a word that starts with a digit, marks between digits included, or one of
``NUMBER_WORDS``; a unit is one of ``UNITS``. Words are compared in lower case. Items of fewer words
than a window, but at least ``SHORTEST``, are one window of their own length. Documents are read for
such items, and for those that are looked for word for word, only if there are any.

Edge cases: a null or empty text, and an item of fewer than SHORTEST words, match nothing; texts that share a doc_id, or an item_id, null ids among them, are matched each for itself, and give one
row for each (doc_id, item_id), that of the best match; repeated rows give one; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, small, table

QUERY = "op6_template_decontaminate"
WINDOW, LITERALS, SHARE, SHORTEST = 5, 2, 0.8, 4
#: The benchmark's windows are broadcast up to so many (of some 60 bytes each); beyond, both sides are
#: shuffled, and windows that very many documents have are split as skewed by the adaptive join.
BROADCAST_WINDOWS = 200_000
# Put before a name, so that it is still told when all is in lower case; from the private use area.
NAME_MARK = "\ue001"
# Codes of the placeholders, where words have hashes.
NUMBER, NAME, UNIT = 1, 2, 3
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million"
UNITS = "kg mg km cm mm mi mile miles feet ft inch inches ml liter liters litre litres hour hours minute minutes second seconds day days week weeks month months year years dollar dollars euro euros pound pounds cent cents percent degree degrees"


def template_words(text: Column, capitals: bool = False) -> Column:
    """The text's words in lower case, names (or all words with capitals) with a mark before them."""
    before = r"(?<![\p{L}\p{N}].)" if capitals else r"(?<=[a-z,;] .)"
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), rf"\p{{Lu}}{before}(?=\p{{Ll}})", NAME_MARK + "$0")
    # a mark between digits belongs to the number
    cut = F.split(F.lower(marked), rf"(?:[^\p{{L}}\p{{N}}{NAME_MARK}](?!(?<=[0-9].)[0-9]))+")
    return F.filter(cut, lambda w: w != "")


def placeholder(word: Column) -> Column:
    """The code of the placeholder that stands for a word, or null."""
    first = F.ascii(word)
    number = first.between(ord("0"), ord("9")) | word.isin(NUMBER_WORDS.split())
    return F.when(first == ord(NAME_MARK), NAME).when(number, NUMBER).when(word.isin(UNITS.split()), UNIT)


def windows(rows: DataFrame, id_col: str, text_col: str, names: tuple[str, ...], window: int = WINDOW, capitals: bool = False, plain: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep, pos, key, first, last, literals): a row a window. key is a hash of its template; first and
    last are hashes of what stands in the slots at its ends, null where there is none. ``plain``: no
    word is a placeholder."""
    ids = (names[0], *keep)
    words = rows.select(F.col(id_col).cast("long").alias(names[0]), *keep, template_words(F.col(text_col), capitals).alias("w"))
    hashed = words.select(*ids, "w", F.transform("w", lambda w: F.xxhash64(F.regexp_replace(w, NAME_MARK, "")) if plain else F.coalesce(placeholder(w).cast("long"), F.xxhash64(w))).alias("h"), F.size("w").alias("n")).where(F.col("n") >= window)
    is_slot = lambda h: h.between(NUMBER, UNIT)
    slots = F.when(F.exists("h", is_slot), F.transform("w", lambda w, i: F.when(is_slot(F.get("h", i)), F.xxhash64(w))))
    hashed = hashed.select(*ids, "h", "n", F.coalesce(slots, F.array(F.lit(None).cast("long"))).alias("v"))
    at = lambda c, i: F.slice(c, i + 1, F.col("n"))
    zipped = F.arrays_zip(*[(at(F.col("h"), i) if i else F.col("h")).alias(f"h{i}") for i in range(window)], F.col("v").alias("first"), F.slice("v", window, F.col("n")).alias("last"))
    out = hashed.select(*ids, F.posexplode(zipped).alias(names[1], "z"))
    parts = [F.col(f"z.h{i}") for i in range(window)]
    literals = sum((F.when(is_slot(p), 0).otherwise(1) for p in parts[1:]), F.when(is_slot(parts[0]), 0).otherwise(1))
    return out.where(parts[-1].isNotNull()).select(*ids, names[1], F.xxhash64(*parts).alias("key"), F.col("z.first").alias(names[2]), F.col("z.last").alias(names[3]), literals.alias("literals"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched) for each document that holds a benchmark item: of its texts and the item's the two
    that match best."""
    # each text is matched for itself, whatever ids it shares
    items = items.select("item_id", "text").dropDuplicates(["item_id", "text"])
    items = items.withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", F.col("text").isNull(), "text"))
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("own"))
    forms = [{"capitals": False}, {"capitals": True}]
    found = reduce(DataFrame.unionByName, [_found(docs, items, window, share, **f) for f in forms])
    n = F.size(template_words(F.col("text")))
    short = [r.n for r in items.select(n.alias("n")).where((F.col("n") >= SHORTEST) & (F.col("n") < window)).distinct().collect()]  # window - SHORTEST at most
    for size in sorted(short):
        found = reduce(DataFrame.unionByName, [_found(docs, items.where(n == size), size, share, **f) for f in forms], found)
    telling = reduce(DataFrame.unionByName, [_item_windows(items, window, **f).select("item") for f in forms]).distinct()
    bare = checkpoint(items.where(n >= window).join(telling, "item", "left_anti"))
    if not bare.isEmpty():
        found = found.unionByName(_found(docs, bare, window, share, plain=True))
    # equal shares: the one of more windows
    best = F.max(F.struct((F.col("n_matched") / F.col("n_windows")).alias("share"), "n_windows", "n_matched")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_windows", "best.n_matched")


def _item_windows(items: DataFrame, window: int, **form) -> DataFrame:
    """The items' telling windows."""
    own = windows(items, "item", "text", ("item", "ipos", "ifirst", "ilast"), window, keep=("item_id",), **form)
    return own.where(F.col("literals") >= LITERALS).drop("literals")


def _found(docs: DataFrame, items: DataFrame, window: int, share: float, **form) -> DataFrame:
    """``contaminated`` by one form of windows, one of the two templates, or plain; a row for each text of a document and of an item."""
    own = checkpoint(_item_windows(items, window, **form))
    whole = own.groupBy("item").agg(F.count_distinct("ipos").alias("n_windows"), F.first("item_id").cast("long").alias("item_id"))
    side = small(own.drop("item_id"), BROADCAST_WINDOWS)
    rows = windows(docs, "doc_id", "text", ("doc_id", "pos", "dfirst", "dlast"), window, keep=("own",), **form).drop("literals")
    found = rows.join(side, "key")
    pair = lambda i, d: F.collect_set(F.when(F.col(i).isNotNull(), F.struct(F.col(i).alias("i"), F.col(d).alias("d"))))
    # along one alignment a window of the item is met once at most, so these sets are no longer than an item
    aligned = found.groupBy("doc_id", "own", "item", (F.col("pos") - F.col("ipos")).alias("shift")).agg(F.collect_set("ipos").alias("met"), F.array_union(pair("ifirst", "dfirst"), pair("ilast", "dlast")).alias("slots"))
    consistent = F.size(F.array_distinct(F.transform("slots", lambda s: s["i"]))) == F.size("slots")
    met = aligned.where(consistent).select("doc_id", "own", "item", F.explode("met").alias("ipos")).distinct()
    counts = met.groupBy("doc_id", "own", "item").agg(F.count("*").alias("n_matched"))
    return counts.join(whole, "item").where(F.col("n_matched") >= share * F.col("n_windows")).select("doc_id", "item_id", "n_windows", "n_matched")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
