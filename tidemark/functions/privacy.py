"""Pseudonyms: stable surrogates of names and addresses under a secret salt."""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What counts as an address and a phone number in free text, and the surrogates' prefixes.
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+"
PHONE = r"\+?\p{Nd}[\p{Nd}\s()-]{7,}\p{Nd}"
PERSON, ADDRESS, PHONE_MARK = "PER", "EML", "[PHONE]"
FREE_TEXT = ("subject", "title", "short_description", "description", "resolution")


def surrogate(value: Column, prefix: str, salt: str) -> Column:
    """``prefix_`` and six hex digits of the salted hash; case and white space around don't matter, null stays null."""
    plain = F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat(F.lit(f"{salt}:{prefix}:"), plain), 256), 1, 6))


def scrub_text(text: Column, salt: str) -> Column:
    """Each e-mail address as its surrogate, then each phone number as a mark."""
    between, found = F.split(text, EMAIL, -1), F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))
    known = F.transform(found, lambda m: surrogate(m, ADDRESS, salt))
    joined = F.array_join(F.zip_with(between, known, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    scrubbed = F.when(F.instr(text, "@") > 0, joined).otherwise(text)
    return F.regexp_replace(scrubbed, PHONE, F.lit(PHONE_MARK))


def anonymize(df: DataFrame, salt: str, text_columns: tuple[str, ...] = FREE_TEXT, generic: bool = True) -> DataFrame:
    """Names and addresses as surrogates, phone columns dropped, free text scrubbed.

    Columns are told by their ends (``_name``, ``_email``, ``_phone``, ``_mobile``); with ``generic``
    also by the bare names that list-only modules use.
    """
    end = lambda c, *ends: any(c.endswith(f"_{e}") or (generic and c == e) for e in ends)
    changed = {}
    for c, kind in df.dtypes:
        if kind != "string":
            continue
        if c in text_columns:
            changed[c] = scrub_text(F.col(c), salt)
        elif end(c, "email", "email_id"):
            changed[c] = surrogate(F.col(c), ADDRESS, salt)
        elif end(c, "name"):
            changed[c] = surrogate(F.col(c), PERSON, salt)
    return df.withColumns(changed).drop(*[c for c in df.columns if end(c, "phone", "mobile")])


def reidentification(df: DataFrame, columns: dict[str, str], salt: str) -> DataFrame:
    """(kind, value, surrogate): each value of the columns once; ``columns`` gives each one's prefix."""
    parts = [df.select(F.lit(p).alias("kind"), F.col(c).alias("value")).where(F.col("value").isNotNull()) for c, p in columns.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    pick = F.lit(None).cast("string")
    for p in set(columns.values()):
        pick = F.when(F.col("kind") == p, surrogate(F.col("value"), p, salt)).otherwise(pick)
    return union.distinct().withColumn("surrogate", pick)


def new_salt() -> str:
    """A random salt of 16 bytes."""
    return secrets.token_hex(16)


def stored_salt(spark: SparkSession, folder: str) -> str | None:
    """The salt of the map in a folder, so that later runs give the same surrogates."""
    from tidemark.sources.storage import Store

    kept = Store(spark, folder).read_json("salt.json")
    return kept.get("salt") if isinstance(kept, dict) else None


def save_map(entries: DataFrame, salt: str, folder: str) -> None:
    """Keep a re-identification map (kind, value, surrogate) with its salt.

    Entries of earlier runs stay if they were made with the same salt; a map of another salt is replaced.
    """
    from tidemark.sources.storage import Store

    spark, new = entries.sparkSession, f"map-{secrets.token_hex(8)}"
    store = Store(spark, folder)
    known = store.read_json("salt.json")
    if isinstance(known, dict) and known.get("salt") == salt and store.exists(known.get("map", "")):
        entries = spark.read.parquet(f"{folder}/{known['map']}").unionByName(entries)
    entries.distinct().write.parquet(f"{folder}/{new}")
    # the document says which map holds, so a run that fails before this line changes nothing
    store.write_json("salt.json", {"salt": salt, "map": new})
    if isinstance(known, dict) and known.get("map"):
        store.delete(known["map"])


def load_map(spark: SparkSession, folder: str) -> DataFrame | None:
    """(kind, value, surrogate) as kept by ``save_map``."""
    from tidemark.sources.storage import Store

    known = Store(spark, folder).read_json("salt.json")
    return spark.read.parquet(f"{folder}/{known['map']}") if isinstance(known, dict) else None


def prefix_of(column: str, generic: bool = True) -> str | None:
    """Which surrogate an identifying column gets, by the end of its name."""
    for ends, prefix in ((("email", "email_id"), ADDRESS), (("name",), PERSON)):
        if any(column.endswith(f"_{e}") or (generic and column == e) for e in ends):
            return prefix
    return None


def map_of(df: DataFrame, salt: str) -> DataFrame | None:
    """The re-identification map of a table's identifying columns; None if it has none."""
    columns = {c: p for c, kind in df.dtypes if kind == "string" and c not in FREE_TEXT and (p := prefix_of(c))}
    return reidentification(df, columns, salt) if columns else None
