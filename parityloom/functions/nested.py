"""JSON, arrays, maps and structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import saved, small

#: Levels of a tree that one plan opens.
LEVELS = 4


def list_to_json(values: Column) -> Column:
    """JSON text of a list; [] for null."""
    return F.coalesce(F.to_json(values), F.lit("[]"))


def list_to_text(values: Column, sep: str = "|") -> Column:
    return F.coalesce(F.array_join(values, sep), F.lit(""))


def text_to_list(text: Column) -> Column:
    """A JSON list, or the whole text as the only entry; empty for blank and null."""
    raw = F.trim(F.coalesce(text, F.lit("")))
    parsed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    return F.when(raw == "", F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(raw)))


def strict_object(text: Column, keys: Sequence[str], require_all: bool = False) -> Column:
    """The object as a map if it is one, has no other keys and only strings; else null."""
    raw = F.trim(F.coalesce(text, F.lit("")))
    found = F.json_object_keys(raw)
    known = F.array(*map(F.lit, keys))
    ok = raw.startswith("{") & raw.endswith("}") & found.isNotNull() & (F.size(F.array_except(found, known)) == 0)
    if require_all:
        ok = ok & (F.size(F.array_except(known, found)) == 0)
    parsed = F.from_json(raw, "map<string,variant>")
    strings = F.forall(F.map_values(parsed), lambda v: F.schema_of_variant(v) == "STRING")
    return F.when(ok & F.coalesce(strings, F.lit(False)), F.from_json(raw, "map<string,string>"))


def lenient_field(text: Column, key: str, default: str = "") -> Column:
    """A field of the widest {...} in the text, or the default."""
    body = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?s)\{.*\}", 0)
    return F.coalesce(F.get_json_object(body, f"$.{key}"), F.lit(default))


def bounded_fields(rows: DataFrame, values: str, bounds: DataFrame) -> DataFrame:
    """Keys of the map column whose text is shorter or longer than bounds (key, least, most) say."""
    return rows.select("*", F.explode_outer(values).alias("key", "value")).join(small(bounds), "key").where(~F.length("value").between(F.col("least"), F.col("most")))


def tree_leaves(rows: DataFrame, tree: str, keep: Sequence[str] = (), most: int = 100) -> DataFrame:
    """(keep, path, kind, value) of every leaf of a VARIANT column, however deep; path is an array of keys, and of places as text.

    A round opens up to LEVELS levels of objects and lists, all rows at once and without a shuffle; leaves of the first
    levels pass through the others as they are. The table is written between rounds, so a plan is a few levels deep, and only
    rows that are still open are opened again. Leaves are texts, numbers, booleans, nulls, and empty objects
    and lists; value is the leaf as text, null for a null. A null column has no leaf. More than `most` levels are an error.
    """
    keep, v = list(keep), F.col("v_")
    now = rows.where(F.col(tree).isNotNull()).select(*keep, F.array().cast("array<string>").alias("path"), F.col(tree).alias("v_"))
    # one level of a value, whatever lies below it
    fields = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    places = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value")))
    inside = F.coalesce(fields, places)
    out, opened = None, 0
    while opened < most:
        levels = min(LEVELS, most - opened)
        for _ in range(levels):
            known = now.withColumn("in_", inside)
            itself = F.array(F.struct(F.lit(None).cast("string").alias("key"), v.alias("value")))
            known = known.withColumn("in_", F.when(F.size("in_") > 0, F.col("in_")).otherwise(itself))
            each = known.select(*keep, "path", F.explode("in_").alias("x_"))
            now = each.select(*keep, F.when(F.col("x_.key").isNull(), F.col("path")).otherwise(F.concat("path", F.array("x_.key"))).alias("path"), F.col("x_.value").alias("v_"))
        opened += levels
        n_inside = F.size(inside)
        now = saved(now.withColumn("open_", F.coalesce(n_inside > 0, F.lit(False))), "tree")
        kind, closed = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), now.where("NOT open_")
        leaf = closed.select(*keep, "path", kind.alias("kind"), "v_").select(*keep, "path", "kind", F.when(F.col("kind").isin("OBJECT", "ARRAY"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string")).alias("value"))
        out = leaf if out is None else out.unionByName(leaf)
        now = now.where("open_").drop("open_")
        if now.isEmpty():
            return out
    raise ValueError(f"a tree has more than {most} levels")


def at_path(tree: Column, path: str, kind: str = "double", default=0.0) -> Column:
    """The value at a path like $.a.b[0] of a VARIANT, or the default if there is none of that kind."""
    return F.coalesce(F.try_variant_get(tree, path, kind), F.lit(default).cast(kind))


def leaves(rows: DataFrame, nested: str) -> DataFrame:
    """(outer, inner, value) of a map of maps."""
    return rows.select(F.explode(nested).alias("outer", "m")).select("outer", F.explode("m").alias("inner", "value"))


def lookup(nested: Column, *path: Column, default: float = 0.0) -> Column:
    for key in path:
        nested = F.try_element_at(nested, key)
    return F.coalesce(nested, F.lit(default))


def object_fields(rows: DataFrame, json_col: str) -> DataFrame:
    """One row for each field (key, value) of a JSON object column."""
    return rows.select("*", F.explode(F.from_json(json_col, "map<string,string>")).alias("key", "value"))
