"""Records as flat tables: fixed builders for requests and problems, a discovered one for other modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import list_size, person, pick, resolution
from tidemark.functions.text import clean_html, detect_lang, has_resolution, is_junk
from tidemark.functions.time import parse_epoch, time_features

_V = "record"


def _time(name: str) -> Column:
    return parse_epoch(pick(F.col(_V), f"{name}.value"))


def _flag(name: str) -> Column:
    return F.try_variant_get(_V, f"$.{name}", "boolean")


def _html(name: str) -> Column:
    return clean_html(pick(F.col(_V), name))


def flatten_requests(records: DataFrame) -> DataFrame:
    """The 35 columns of requests from variants in ``record``."""
    v = F.col(_V)
    cols: dict[str, Column] = {"id": pick(v, "id"), "subject": pick(v, "subject"), "short_description": _html("short_description")}
    cols |= {k: pick(v, f"{k}.name") for k in ("status", "priority", "group", "template", "site")}
    cols |= {k: _flag(k) for k in ("is_service_request", "is_overdue", "cancel_requested")}
    cols |= {"created_time": _time("created_time"), "due_by_time": _time("due_by_time")}
    for who in ("requester", "technician", "created_by"):
        cols |= person(F.try_variant_get(v, f"$.{who}", "variant"), who)
    flat = records.select(*[c.alias(k) for k, c in cols.items()])
    flat = flat.withColumns(time_features(F.col("created_time")))
    text = F.concat_ws(" ", F.coalesce("subject", F.lit("")), F.col("short_description"))
    return flat.withColumns({"subject_len": F.length(F.coalesce("subject", F.lit(""))), "desc_len": F.length("short_description"), "lang": detect_lang(text)})


def flatten_problems(records: DataFrame) -> DataFrame:
    """The 36 columns of problems; the description falls back on the short one."""
    v = F.col(_V)
    cols: dict[str, Column] = {"id": pick(v, "id"), "title": pick(v, "title"), "description": F.coalesce(F.nullif(_html("description"), F.lit("")), _html("short_description"))}
    cols |= {k: pick(v, f"{k}.name") for k in ("status", "priority", "impact", "urgency", "category", "subcategory", "item", "group")}
    cols |= {k: _time(k) for k in ("reported_time", "closed_time", "due_by_time", "updated_time")}
    cols |= {"has_resolution": has_resolution(pick(v, "resolution")), "resolution_is_junk": is_junk(pick(v, "resolution")), "workaround_is_junk": is_junk(pick(v, "workaround")), "notes_present": _flag("notes_present")}
    for who in ("reported_by", "technician"):
        cols |= person(F.try_variant_get(v, f"$.{who}", "variant"), who)
    flat = records.select(*[c.alias(k) for k, c in cols.items()])
    flat = flat.withColumns(time_features(F.col("reported_time"), F.col("closed_time")))
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.col("description"))
    return flat.withColumns({"title_len": F.length(F.coalesce("title", F.lit(""))), "desc_len": F.length("description"), "lang": detect_lang(text)})


def flatten_generic(records: DataFrame) -> DataFrame:
    """Any module's records. One pass finds the fields and their kinds, then each becomes a column:

    an object with value and display_value a timestamp, one with a name (null or not) the name, another
    its id, a list ``field_count``, anything else itself as text.
    """
    v = F.col(_V)
    fields = records.select(F.explode(F.try_variant_get(v, "$", "map<string,variant>")).alias("k", "x"))
    kind = F.schema_of_variant("x")
    inner = F.map_keys(F.try_variant_get("x", "$", "map<string,variant>"))
    what = F.when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), F.when(F.array_contains(inner, "value") & F.array_contains(inner, "display_value"), "time").otherwise("object")).when(kind == "VOID", "null").otherwise("scalar")
    found: dict[str, set] = {}
    for r in fields.select("k", what.alias("what")).distinct().collect():  # as many rows as the module has fields
        found.setdefault(r.k, set()).add(r.what)
    cols = []
    for k in sorted(found):
        whole = F.try_element_at("__fields", F.lit(k))  # by the map, as a path can't say every name
        kinds = found[k] - {"null"}
        if kinds == {"list"}:
            cols.append(list_size(whole).alias(f"{k}_count"))
            continue
        if kinds == {"time"}:
            cols.append(parse_epoch(F.try_variant_get(whole, "$.value", "string")).alias(k))
            continue
        keys = F.map_keys(F.try_variant_get(whole, "$", "map<string,variant>"))
        named = F.when(F.array_contains(keys, "name"), F.try_variant_get(whole, "$.name", "string")).otherwise(F.try_variant_get(whole, "$.id", "string"))
        cols.append((F.when(F.schema_of_variant(whole).startswith("OBJECT"), named).otherwise(F.try_variant_get(whole, "$", "string")) if "object" in kinds else F.try_variant_get(whole, "$", "string")).alias(k))
        if "list" in kinds:
            cols.append(list_size(whole).alias(f"{k}_count"))
    return records.select(F.try_variant_get(v, "$", "map<string,variant>").alias("__fields")).select(*cols)


BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {"requests": flatten_requests, "problems": flatten_problems}


def build(records: DataFrame, module: str, details: DataFrame | None = None) -> DataFrame:
    """A module's table from its records, enriched by details (id, bundle), once for each id."""
    from tidemark.sources.files import dedup

    flat = BUILDERS.get(module, flatten_generic)(dedup(records))
    return flat if details is None else enrich(flat, details, module)


def enrich(flat: DataFrame, details: DataFrame, module: str) -> DataFrame:
    """With notes_count, attachments_count, and description and resolution where the details have them."""
    one = module[:-1]
    payload = F.coalesce(F.try_variant_get("bundle", f"$.detail.{one}", "variant"), F.try_variant_get("bundle", "$.detail", "variant"))
    notes = F.map_values(F.try_variant_get("bundle", "$.notes", "map<string,variant>"))
    lists = F.filter(F.transform(notes, list_size), lambda n: n.isNotNull())
    extra = details.select(
        F.col("id").alias("__id"),
        F.get(lists, F.lit(0)).alias("notes_count"),
        F.size(F.try_variant_get(payload, "$.attachments", "array<variant>")).alias("attachments_count"),
        F.nullif(clean_html(F.try_variant_get(payload, "$.description", "string")), F.lit("")).alias("__description"),
        F.nullif(clean_html(resolution(payload)), F.lit("")).alias("__resolution"),
    )
    joined = flat.join(extra, flat["id"] == extra["__id"], "left")
    old = lambda c: F.col(c) if c in flat.columns else F.lit(None).cast("string")
    out = joined.withColumns({"description": F.coalesce("__description", old("description")), "resolution": F.coalesce("__resolution", old("resolution"))})
    return out.drop("__id", "__description", "__resolution")
