"""Reading fields of JSON held as variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The text's JSON as a variant; null if it is none."""
    return F.try_parse_json(text)


def pick(v: Column, key: str = "name", kind: str = "string") -> Column:
    """A field of an object; null if the value is none or lacks it."""
    return F.try_variant_get(v, f"$.{key}", kind)


def person(v: Column, prefix: str) -> dict[str, Column]:
    """Name, address, id, department and site of a person object."""
    paths = {"name": "name", "email": "email_id", "id": "id", "dept": "department.name", "site": "department.site.name"}
    return {f"{prefix}_{k}": pick(v, p) for k, p in paths.items()}


def list_size(v: Column) -> Column:
    """How many items a list has; null if the value is no list."""
    return F.size(F.try_variant_get(v, "$", "array<variant>"))


def resolution(detail: Column) -> Column:
    """``resolution.content`` or a plain ``resolution``."""
    whole = F.try_variant_get(detail, "$.resolution", "variant")
    plain = F.when(F.schema_of_variant(whole) == "STRING", F.try_variant_get(whole, "$", "string"))
    return F.coalesce(F.try_variant_get(detail, "$.resolution.content", "string"), plain)
