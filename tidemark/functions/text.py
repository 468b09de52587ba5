"""Text functions on columns. White space and digits are Unicode's where the classes say ``(?U)``."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The scripts that language detection tells apart, and the share from which a text is mixed.
ARABIC, LATIN = "[\\u0600-\\u06FF]", "[A-Za-z]"
MIXED_ABOVE = 0.15
# Closings that start a signature, in the order in which they are cut; a dot ends at a line end.
SIGNATURES = [r"regards[,\s].*", r"best\s+regards.*", r"thanks[,\s].*", "تحياتي.*", "وتقبلوا.*", "مع الشكر.*"]
# Words that say nothing about a cluster.
STOP_WORDS = (
    "the a an and or to of for in on is are was were be this that i we you my our your it "
    "please kindly dear hi hello regards thanks thank ال في من على الى عن هذا هذه"
).split()


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x{A0}]+", " "))


def detect_lang(c: Column) -> Column:
    """ar, en, mixed or unknown by the counts of Arabic and Latin letters; null is unknown."""
    ar, en = F.regexp_count(c, F.lit(ARABIC)), F.regexp_count(c, F.lit(LATIN))
    return (
        F.when(c.isNull() | (ar + en == 0), "unknown")
        .when((F.least(ar, en) > 0) & (F.least(ar, en) / (ar + en) > MIXED_ABOVE), "mixed")
        .when(ar > en, "ar")
        .otherwise("en")
    )


def is_junk(c: Column) -> Column:
    """Whether a text is only a number of up to three digits; null is not."""
    return F.coalesce(c.rlike(r"(?U)^\s*\d{1,3}\s*$"), F.lit(False))


def has_resolution(c: Column) -> Column:
    """Whether there is a text that is not junk."""
    return F.coalesce(c != "", F.lit(False)) & ~is_junk(c)


def build_text(*cols: Column, sep: str = " ") -> Column:
    """Columns joined by ``sep``, nulls as empty texts, without white space at the ends; no columns give ''."""
    if not cols:
        return F.lit("")
    return strip(F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def subject_and_body(subject: Column, body: Column) -> Column:
    """``subject. body``; what is missing is empty, so nothing at all gives a dot."""
    return strip(F.concat(F.coalesce(subject, F.lit("")), F.lit(". "), F.coalesce(body, F.lit(""))))


def not_blank(c: Column, least: int = 1) -> Column:
    """Whether there are ``least`` characters or more between white space; null has none."""
    return F.length(strip(F.coalesce(c.cast("string"), F.lit("")))) >= least


def truncate(c: Column, most: int) -> Column:
    """The first ``most`` characters."""
    return F.substring(c, 1, most)


def strip_signature(c: Column, longest_first: bool = False) -> Column:
    """Without closings and what follows them on their line, white space collapsed.

    In the fixed order ``regards, A`` goes before ``best regards``, which leaves a stray ``best``;
    with ``longest_first`` the longer closing is tried first.
    """
    for pattern in sorted(SIGNATURES, key=len, reverse=True) if longest_first else SIGNATURES:
        c = F.regexp_replace(c, f"(?id){pattern}", " ")
    return collapse(c)


def tokens(c: Column) -> Column:
    """Words of three letters or more in lower case that are no stop words."""
    words = F.regexp_extract_all(F.lower(c), F.lit("[A-Za-z\\u0600-\\u06FF]{3,}"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


#: What ``(?U)\\s`` stands for in Java's patterns; str.split() takes the four separators from 1C on, too.
_WHITE, _SEPARATORS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"), re.compile("[\x1c-\x1f]")


def blank_parted(text: str) -> list[str]:
    """What stands between white space, as ``(?U)\\s+`` parts it."""
    return [w for w in _WHITE.split(text) if w] if _SEPARATORS.search(text) else text.split()


def char_ngrams(c: Column, low: int = 2, high: int = 5) -> Column:
    """Character n-grams within words that have a blank at both ends, in lower case.

    A padded word that is no longer than n gives itself once, and then no longer n.
    """
    words = F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(w):
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.length(w)))
        starts = lambda n: F.sequence(F.lit(1), F.length(w) - n + 1)
        return F.flatten(F.transform(sizes, lambda n: F.transform(starts(n), lambda i: F.substring(w, i, n))))

    return F.flatten(F.transform(padded, grams))


def word_ngrams(c: Column, high: int = 2) -> Column:
    """Runs of 1 to ``high`` words of at least two letters or digits, in lower case."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    runs = [words]
    for n in range(2, high + 1):  # each run of n - 1 words with the word after it; past the end that is null
        longer = F.zip_with(runs[-1], F.slice(words, n, F.size(words)), lambda run, word: F.concat(run, F.lit(" "), word))
        runs.append(F.filter(longer, lambda run: run.isNotNull()))
    return F.concat(*runs)


def clean_markup(c: Column) -> Column:
    """The text of an HTML page by patterns: no scripts, styles, comments or tags; the common entities resolved."""
    for pattern in (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->", r"<[^>]*>"):
        c = F.regexp_replace(c, pattern, " ")
    for name, value in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(value))
    return collapse(F.coalesce(c, F.lit("")))


_TAGS = (
    r"(?is)<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\z)",
    r"(?s)<!--.*?-->",
    r"""</?[A-Za-z][^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+>""",
    r"<[A-Za-z/!?][^>]*>",
)
#: Named entities, with ``;`` or (an old few) without; numbers 128 to 159 stand for what Windows shows.
_NAMED = json.dumps(html5)
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_ENTITY = rf"&(?:#[0-9]{{1,7}};?|#[xX][0-9a-fA-F]{{1,6}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{_BARE}))"
_ENDED = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_SHOWN = "".join(bytes([i]).decode("cp1252", "replace") for i in range(128, 160))


def unescape(c: Column, bare: bool = True) -> Column:
    """The text with every HTML entity resolved; what is none stays. Without ``bare`` an entity must end in ``;``."""
    names = F.from_json(F.lit(_NAMED), "map<string,string>")
    entity = _ENTITY if bare else _ENDED

    def character(code):
        code = F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), 0xFFFD).otherwise(code)
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code.between(128, 159), F.substring(F.lit(_SHOWN), (code - 127).cast("int"), F.lit(1))).otherwise(plain)

    def value(m):
        body = F.substring(m, F.lit(2), F.length(m))
        number = F.regexp_replace(body, "[#xX;]", "")
        hexed = F.substring(body, 2, 1).isin("x", "X")
        code = F.when(hexed, F.conv(number, 16, 10)).otherwise(number).cast("bigint")
        named = F.try_element_at(names, body)
        if bare:
            old = F.regexp_extract(body, f"^({_BARE})", 1)
            named = F.coalesce(named, F.when(old != "", F.concat(F.try_element_at(names, old), F.substring(body, F.length(old) + 1, F.length(body)))))
        named = F.coalesce(named, m)
        return F.when(body.startswith("#"), character(code)).otherwise(named)

    between, found = F.split(c, entity, -1), F.regexp_extract_all(c, F.lit(entity), F.lit(0))
    joined = F.array_join(F.zip_with(between, F.transform(found, value), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(F.instr(c, "&") > 0, joined).otherwise(c)


def clean_html(c: Column, bare: bool = True) -> Column:
    """The text of an HTML fragment, its parts parted by blanks, with every entity resolved (see ``unescape``); null is ''."""
    for pattern in _TAGS:
        c = F.regexp_replace(c, pattern, " ")
    return collapse(F.coalesce(unescape(c, bare), F.lit("")))
