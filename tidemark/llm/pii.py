"""Personal data by weakly supervised labelers, in DataFrame functions only.

Patterns propose spans: base kinds (email, ip, card, phone), which always stay if their checks pass,
and further kinds (masked_email, local_phone, ssn, secret, name). Five labelers vote on every
proposal, for (1), against (-1) or not at all (0): a stricter pattern, a gazetteer, words that announce
it, signs against it around it, and a check of its characters. Expectation-maximisation over the counts
of each kind's vote patterns, of which there are at most 3 ** 5, estimates how reliable each labeler is
for the kind, and gives each proposal a probability. With these as labels a naive Bayes classifier is
trained for each kind, over features of the span and its surroundings that are not the votes; further
spans stay if it gives them at least ``ACCEPT`` and they overlap no base span.

Matches are found by ``split`` and ``regexp_extract_all``; positions are running sums over the rows
of a text's matches, so a text with very many of them is sorted, not held in an array.

Edge cases: a null text is empty and has no spans; rows with equal doc_id and text are found once and
given back as often as they came; a null doc_id is kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, table

QUERY = "op5_weak_pii"
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "masked_email", "local_phone", "ssn", "secret", "name")
ACCEPT = 0.5
ROUNDS = 20
#: Trust in what labelers are thought to be, as a share of a kind's proposals; words around a span are hashed.
TRUST, CONTEXTS, SMOOTH = 0.5, 64, 2.0
#: Characters of a text that are reached at once when spans are cut out.
BLOCK = 2048
LEFT, RIGHT = 24, 12

# Gazetteers and cue words.
GIVEN_NAMES = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Steven Paul Andrew Joshua Kenneth "
    "Kevin Brian George Edward Peter Frank Henry Walter Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret "
    "Sandra Ashley Emily Donna Michelle Carol Amanda Laura Emma Olivia Sophia Anna Alice Julia Rachel Hans Klaus Jürgen Wolfgang Stefan Andreas "
    "Markus Heike Sabine Petra Monika Ursula Jean Pierre Michel Philippe Nicolas François Marie Nathalie Isabelle Sophie Camille Luis Carlos Juan "
    "José Miguel Antonio Javier María Carmen Ana Lucía Elena Giovanni Marco Giulia Ahmed Mohamed Fatima Ali Omar Wei Li Ming Yuki Hiroshi Ivan Olga"
)
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora"
SECRET_WORDS = "token key secret password passwd pwd credential credentials apikey auth bearer"
PLAIN_WORDS = "id sha commit hash checksum digest class href src url path version session slug etag rev"
DOMAINS = "com org net edu gov io de fr es uk eu info"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
CUES = r"(?i)\b(?:tel|phone|call|fax|mobile|mail|e-mail|email|contact|card|visa|account|iban|ip|host|address|ssn|social|token|key|secret|password|name|mr|mrs|ms|dr|herr|frau|señor|monsieur|madame)\b"

_ANY_NAME, _ANY_TITLE = GIVEN_NAMES.replace(" ", "|"), TITLES.replace(" ", "|")

# The starts that lookbehinds and \G leave out can't begin a leftmost match, and possessive
# quantifiers stand where giving back can't help, so long runs cost linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "masked_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:\(at\)|\[at\])\s?[A-Za-z0-9-]++\s?(?:\(dot\)|\[dot\]|\.)\s?[A-Za-z]{2,}+",
    "local_phone": r"(?<![0-9A-Za-z+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z][A-Za-z_-]*+\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_+/=-]{16,}+[\"']?",
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_ANY_TITLE})\.?\s\p{{Lu}}\p{{Ll}}++(?:\s\p{{Lu}}\p{{Ll}}++)?|(?:{_ANY_NAME})\s\p{{Lu}}\p{{Ll}}++|\p{{Lu}}\p{{Ll}}{{2,}}+\s\p{{Lu}}\p{{Ll}}{{2,}}+)",
}


def _guards(text: Column, digits: Column) -> dict[str, Column]:
    """What a text must have for a pattern to match: cheaper to look for than the pattern."""
    has = lambda s: F.instr(text, s) > 0
    return {
        "email": has("@"),
        "ip": digits & text.rlike(r"[0-9]\.[0-9]"),
        "card": digits & text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": digits & has("+"),
        "masked_email": has("(at)") | has("[at]"),
        "local_phone": digits & text.rlike(r"[0-9]{3}[ .-][0-9]{4}"),
        "ssn": digits & text.rlike("[0-9]-[0-9]{2}-[0-9]"),
        "secret": text.rlike(r"[=:]\s{0,3}[\"']?[A-Za-z0-9_+/=-]{16}"),
        "name": text.rlike(r"\p{Lu}\p{Ll}+\.?\s\p{Lu}\p{Ll}"),
    }


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i):
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def octets(m: Column) -> Column:
    """Whether all parts of a dotted number are at most 255, however many zeros they start with."""
    return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def valid(kind: Column, m: Column) -> Column:
    """The base kinds' checks; True for other kinds."""
    n = F.length(_digits(m))
    return (
        F.when(kind == "ip", octets(m))
        .when(kind == "card", F.when(n.between(13, 19), luhn(_digits(m))).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, kind, start, end, m, left, right) of all matches, once for equal doc_id and text; h is the text's hash."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.col("text").rlike("[0-9]").alias("digits"))
    guards = _guards(F.col("text"), F.col("digits"))
    some = [F.when(guards[k], F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).alias(k) for k in KINDS]
    found = rows.select("doc_id", "h", "text", *some)
    each = F.array_compact(F.array(*[F.when(F.size(F.coalesce(k, F.array())) > 0, F.struct(F.lit(k).alias("kind"), F.col(k).alias("m"))) for k in KINDS]))
    found = found.select("doc_id", "h", "text", F.explode(each).alias("f")).select("doc_id", "h", "f.kind", "f.m", "text")
    pattern = reduce(lambda w, k: w.when(F.col("kind") == k, F.split("text", PATTERNS[k], -1)), KINDS[1:], F.when(F.col("kind") == KINDS[0], F.split("text", PATTERNS[KINDS[0]], -1)))
    found = found.select("doc_id", "h", "kind", "m", pattern.alias("s"))
    zipped = F.arrays_zip(F.col("m"), F.col("s"), F.slice("s", 2, F.size("s")).alias("after"))
    found = found.select("doc_id", "h", "kind", F.posexplode(zipped).alias("pos", "z")).where("z.m is not null")
    found = found.select("doc_id", "h", "kind", "pos", F.length("z.s").alias("lead"), "z.m", F.right("z.s", F.lit(LEFT)).alias("left"), F.left("z.after", F.lit(RIGHT)).alias("right"))
    found = found.repartition("doc_id", "h").dropDuplicates(["doc_id", "h", "kind", "pos"])
    until = F.sum(F.col("lead") + F.length("m")).over(Window.partitionBy("doc_id", "h", "kind").orderBy("pos"))
    found = found.select("doc_id", "h", "kind", until.alias("end"), "m", "left", "right")
    return found.where(valid(F.col("kind"), F.col("m"))).withColumn("start", F.col("end") - F.length("m"))


def _one_word(key: Column, words: str) -> Column:
    return key.rlike(rf"(?:^|[_-])(?:{words.replace(' ', '|')})$")


def votes(kind: Column, m: Column, left: Column, right: Column) -> Column:
    """The five labelers' votes as an array of -1, 0 and 1."""
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    one_of = lambda names, c: c.isin(*names.split())
    n = F.length(_digits(m))
    key = F.lower(F.regexp_extract(m, "^([A-Za-z_-]*)", 1))
    strict = (
        F.when(kind == "email", vote(m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,10}$"), ~m.rlike(r"\.[A-Za-z]{2,}$")))
        .when(kind == "ip", vote(m.rlike(r"^[1-9][0-9]*(?:\.(?:0|[1-9][0-9]*)){3}$"), m.rlike(r"^0|\.0[0-9]")))
        .when(kind == "card", vote(m.rlike(r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$")))
        .when(kind == "phone", vote(m.rlike(r"^\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]+\)[ .-]?)?[0-9]+(?:[ .-][0-9]+)*$"), m.rlike(r"[().-]{2}")))
        .when(kind == "local_phone", vote(m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]"), m.rlike(r"^\(?[01]")))
        .when(kind == "ssn", vote(~m.rlike("^(?:000|666|9)|-00-|-0000$"), m.rlike("^(?:000|666|9)|-00-|-0000$")))
        .when(kind == "secret", vote(m.rlike(r"[=:]\s*[\"']?(?=[A-Za-z0-9_+/=-]*[0-9])(?=[A-Za-z0-9_+/=-]*[A-Za-z])[A-Za-z0-9_+/=-]{20,}[\"']?$"), ~m.rlike("[0-9]")))
        .when(kind == "name", vote(m.rlike(r"\s\p{Lu}\p{Ll}{2,}$"), m.rlike(r"\s\p{Lu}\p{Ll}$")))
        .otherwise(vote(m.rlike(r"[A-Za-z]{2,6}$")))
    )
    gazetteer = (
        F.when(kind.isin("email", "masked_email"), vote(one_of(DOMAINS, F.lower(F.regexp_extract(m, "([A-Za-z0-9-]+)$", 1)))))
        .when(kind == "card", vote(m.rlike("^[3456]"), ~m.rlike("^[23456]")))
        .when(kind == "phone", vote(one_of(CALLING_CODES, F.regexp_extract(m, r"^\+([0-9]{1,2}?)(?:[^0-9]|(?<=^\+[17])|(?<=^\+[0-9]{2}))", 1))))
        .when(kind == "name", vote(m.rlike(rf"(?<!\p{{L}})(?:{_ANY_NAME})(?!\p{{L}})")))
        .when(kind == "secret", vote(_one_word(key, SECRET_WORDS), _one_word(key, PLAIN_WORDS)))
        .when(kind == "ip", vote(m.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")))
        .otherwise(F.lit(0))
    )
    before = vote(left.rlike(CUES) | ((kind == "name") & m.rlike(rf"^(?:{_ANY_TITLE})\.?\s")))
    # two capitalised words that begin a sentence may be capitalised for that
    begins = (kind == "name") & left.rlike(r"(?:^|[.!?:\n]\s*|^\s+)$") & ~m.rlike(rf"^(?:{_ANY_TITLE})\.?\s")
    against = vote(F.lit(False), begins | left.rlike(r"(?:[A-Za-z0-9#_/=]|\bv|\bversion |\bno\. ?)$") | right.rlike(r"^[A-Za-z0-9_/]"))
    distinct = F.size(F.array_distinct(F.split(F.regexp_extract(m, r"[=:]\s*(.*)$", 1), "")))
    check = (
        F.when(kind == "card", vote(n.between(14, 16), F.regexp_replace(_digits(m), "^(.)\\1*$", "") == ""))
        .when(kind == "ip", vote(~m.rlike(r"^0\.|\.255$"), m.rlike(r"^0\.")))
        .when(kind.isin("phone", "local_phone"), vote(n.between(10, 13), F.regexp_replace(_digits(m), "^(.)\\1*$", "") == ""))
        .when(kind == "secret", vote(F.lit(False), distinct < 8))
        .otherwise(F.lit(0))
    )
    return F.array(strict, gazetteer, before, against, check)


LABELERS = 5
#: How likely each labeler is thought to vote -1, 0 and 1 on what is not personal, and on what is.
THOUGHT = (
    ((0.4, 0.4, 0.2), (0.1, 0.3, 0.6)),  # stricter pattern
    ((0.5, 0.4, 0.1), (0.01, 0.39, 0.6)),  # gazetteer
    ((0.1, 0.8, 0.1), (0.1, 0.4, 0.5)),  # words before
    ((0.5, 0.45, 0.05), (0.05, 0.9, 0.05)),  # signs against
    ((0.4, 0.4, 0.2), (0.1, 0.3, 0.6)),  # check
)


def _posterior(v: Column, pi: Column, t: Column) -> Column:
    """P(personal | votes) under reliabilities t: by class, labeler and vote."""
    odds = F.log(pi / (1 - pi))
    for j in range(LABELERS):
        at = v[j] + 1 + 3 * j
        odds = odds + F.log(t[at + 3 * LABELERS] / t[at])
    return 1 / (1 + F.exp(-odds))


def reliabilities(proposals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """A row (kind, pi, t) a kind: the share of true proposals and the labelers' reliabilities, by EM over vote patterns."""
    patterns = proposals.groupBy("kind", "v").agg(F.count("*").cast("double").alias("n"))
    rows = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("ps"))  # at most 3 ** 5 patterns
    start = [x for true in (0, 1) for labeler in THOUGHT for x in labeler[true]]

    def step(state, _):
        weighed = F.transform("ps", lambda p: F.struct(p["v"].alias("v"), p["n"].alias("n"), _posterior(p["v"], state["pi"], state["t"]).alias("r")))

        def improved(ps):
            total = lambda w: F.aggregate(ps, F.lit(0.0), lambda s, p: s + w(p))
            whole = total(lambda p: p["n"])
            share = [lambda p: p["n"] * (1 - p["r"]), lambda p: p["n"] * p["r"]]
            t = []
            for c in (0, 1):
                for j in range(LABELERS):
                    for vote in (-1, 0, 1):
                        seen = total(lambda p, c=c, j=j, vote=vote: F.when(p["v"][j] == vote, share[c](p)).otherwise(0.0))
                        # labelers that agree with each other can't talk a third one down altogether
                        t.append((seen + TRUST * whole * start[c * 3 * LABELERS + 3 * j + vote + 1]) / (total(share[c]) + TRUST * whole))
            pi = (total(share[1]) + 1) / (whole + 2)
            return F.struct(pi.alias("pi"), F.array(*t).alias("t"))

        return F.transform(F.array(weighed), improved)[0]

    first = F.struct(F.lit(0.5).alias("pi"), F.array(*map(F.lit, start)).alias("t"))
    return rows.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, step).alias("em")).select("kind", "em.pi", "em.t")


def features(kind: Column, m: Column, left: Column, right: Column) -> Column:
    """The span classifier's features, as an array of names with values, each with its kind; votes are not among them."""
    size = F.length(m)
    bucket = lambda x, width, most: F.least(F.floor(x / width), F.lit(most)).cast("string")
    near = lambda c: F.when(c == "", "edge").when(c.rlike(r"\s"), "blank").when(c.rlike(r"[\p{L}]"), "letter").when(c.rlike("[0-9]"), "digit").otherwise("mark")
    share = lambda pattern: F.floor(F.regexp_count(m, F.lit(pattern)) * 4 / size).cast("string")
    # the forms of the parts: a run of capitals A, small letters a, digits 0
    shape = F.left(F.regexp_replace(F.regexp_replace(F.regexp_replace(m, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), "[0-9]+", "0"), F.lit(8))
    word = F.lower(F.regexp_extract(left, r"([\p{L}]+)[^\p{L}]*$", 1))
    said = F.when(word == "", "none").otherwise(F.pmod(F.xxhash64(word), F.lit(CONTEXTS)).cast("string"))
    first = F.pmod(F.xxhash64(F.lower(F.regexp_extract(m, r"^([\p{L}_]+)", 1))), F.lit(CONTEXTS)).cast("string")
    own = [F.lit("all"), bucket(size, 4, 12), near(F.right(left, F.lit(1))), near(F.left(right, F.lit(1))), share("[0-9]"), share(r"\p{Lu}"), shape, said, first, F.left(m, F.lit(1))]
    return F.array(*[F.concat(kind, F.lit(f":{i}="), c) for i, c in enumerate(own)])


def classifier(proposals: DataFrame, em: DataFrame) -> DataFrame:
    """One row (priors, weights): naive Bayes log odds by kind and by feature, trained on the probabilities that EM gives."""
    params = em.agg(F.map_from_entries(F.collect_list(F.struct("kind", F.struct("pi", "t"))))).scalar()  # a row a kind
    known = proposals.select("kind", "f", "v", params.alias("all")).select("kind", "f", "v", F.try_element_at("all", F.col("kind")).alias("em"))
    r = known.select("kind", "f", _posterior(F.col("v"), F.col("em.pi"), F.col("em.t")).alias("r"))
    by_value = r.select("kind", F.explode("f").alias("f"), "r").groupBy("kind", "f").agg(F.sum("r").alias("yes"), F.sum(1 - F.col("r")).alias("no"))
    # at most some thousand values of ten features for each kind
    by_kind = by_value.groupBy("kind").agg(F.collect_list(F.struct("f", "yes", "no")).alias("fs"))
    total = lambda c: F.filter("fs", lambda x: x["f"].contains(":0="))[0][c]
    # a feature that says little of a class is as frequent there as in all
    part = lambda x, c: (x[c] + SMOOTH * (x["yes"] + x["no"]) / (F.col("yes") + F.col("no"))) / (F.col(c) + SMOOTH)
    by_kind = by_kind.select("kind", "fs", total("yes").alias("yes"), total("no").alias("no"))
    weigh = F.transform(F.filter("fs", lambda x: ~x["f"].contains(":0=")), lambda x: F.struct(x["f"].alias("f"), (F.log(part(x, "yes")) - F.log(part(x, "no"))).alias("w")))
    own = by_kind.select("kind", F.log((F.col("yes") + 1) / (F.col("no") + 1)).alias("prior"), weigh.alias("ws"))
    return own.agg(F.map_from_entries(F.collect_list(F.struct("kind", "prior"))).alias("priors"), F.map_from_entries(F.flatten(F.collect_list("ws"))).alias("weights"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, h, kind, base, start, end, score): base spans, and the further ones that the classifier accepts."""
    found = occurrences(docs, id_col, text_col)
    found = found.withColumn("v", votes(F.col("kind"), F.col("m"), F.col("left"), F.col("right")))
    found = found.select("doc_id", "h", "kind", "start", "end", "v", features(F.col("kind"), F.col("m"), F.col("left"), F.col("right")).alias("f"))
    found = checkpoint(found)
    model = classifier(found, reliabilities(found)).select(F.struct("priors", "weights")).scalar()
    odds = F.aggregate("f", F.coalesce(F.try_element_at(F.col("model.priors"), F.col("kind")), F.lit(0.0)), lambda s, x: s + F.coalesce(F.try_element_at(F.col("model.weights"), x), F.lit(0.0)))
    base = F.col("kind").isin(*BASE)
    scored = found.select("doc_id", "h", "kind", base.alias("base"), "start", "end", "f", model.alias("model"))
    scored = scored.select("doc_id", "h", "kind", "base", "start", "end", (1 / (1 + F.exp(-odds))).alias("score"))
    of_text = Window.partitionBy("doc_id", "h").orderBy("start", F.col("base").desc(), "end", "kind")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(of_text.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(of_text.rowsBetween(1, Window.unboundedFollowing))
    taken = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    kept = scored.withColumn("taken", taken).where(F.col("base") | ((F.col("score") >= accept) & ~F.col("taken")))
    return kept.drop("taken")


def summary(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: counts of its base spans, the digest of the base spans and all spans as text."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    lists = F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "base", name.alias("name"))))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE]
    own = found.groupBy("doc_id", "h").agg(*counts, lists.alias("all"))
    names = lambda xs: F.array_join(F.transform(xs, lambda x: x["name"]), ",")
    own = own.select(F.col("doc_id").alias("d"), "h", *[f"n_{k}" for k in BASE], F.sha2(names(F.filter("all", lambda x: x["base"])), 256).alias("base_sha256"), names(F.col("all")).alias("spans"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    none = F.sha2(F.lit(""), 256)
    joined = rows.join(own, rows["doc_id"].eqNullSafe(own["d"]) & (rows["h"] == own["h"]), "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE], F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with each span of ``text_col`` replaced by its kind in brackets; overlapping spans become one."""
    of_text = Window.partitionBy("doc_id", "h").orderBy("start", F.col("end").desc(), "kind")
    fresh = found.withColumn("reach", F.max("end").over(of_text.rowsBetween(Window.unboundedPreceding, -1))).withColumn("new", (F.coalesce("reach", F.lit(-1)) <= F.col("start")).cast("int"))
    merged = fresh.withColumn("g", F.sum("new").over(of_text)).groupBy("doc_id", "h", "g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind"))
    cuts = merged.groupBy(F.col("doc_id").alias("__d"), F.col("h").alias("__h")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__cuts"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(cuts, F.col(id_col).cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(text) == F.col("__h")), "left")
    # in blocks, so that a piece is reached without counting the characters before it
    joined = joined.withColumn("__b", F.when(F.col("__cuts").isNotNull(), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))

    def between(start, end):
        a, b = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
        at = lambda k: F.coalesce(F.get("__b", k), F.lit(""))
        spread = F.concat(F.substring(at(a), start % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice("__b", a + 2, F.greatest(b - a - 1, F.lit(0))), ""), F.substring(at(b), F.lit(1), end % BLOCK))
        return F.when(a == b, F.substring(at(a), start % BLOCK + 1, end - start)).otherwise(spread)

    until = lambda i: F.when(i == 0, 0).otherwise(F.get("__cuts", i - 1)["end"]).cast("int")
    pieces = F.transform("__cuts", lambda c, i: F.concat(between(until(i), c["start"].cast("int")), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    tail = between(F.element_at("__cuts", -1)["end"].cast("int"), F.length(text))
    clean = F.when(F.col("__cuts").isNull(), F.col(text_col)).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return joined.select(*[clean.alias(c) if c == text_col else docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return summary(docs, spans(docs))
