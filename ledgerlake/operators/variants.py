"""JSON documents: parse, path access, flattening."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# column name -> (JSON path, Spark type)
Fields = dict[str, tuple[str, str]]


def parse(text: Column, lenient: bool = False) -> Column:
    return F.try_parse_json(text) if lenient else F.parse_json(text)


def get(value: Column, path: str, type_: str, lenient: bool = False) -> Column:
    """Typed path access. Strict by default: a value that does not fit raises."""
    return F.try_variant_get(value, path, type_) if lenient else F.variant_get(value, path, type_)


def array_at(value: Column, path: str) -> Column:
    """The array under ``path``, NULL when missing or not an array."""
    return F.try_variant_get(value, path, "array<variant>")


def record_count(page: Column, *keys: str) -> Column:
    """Size of the first array present among ``keys``, 0 when there is none."""
    # Elements are only counted: as flags (mostly NULL) they need no copy of their documents.
    sizes = [F.array_size(F.try_variant_get(page, f"$.{k}", "array<boolean>")) for k in keys]
    return F.coalesce(*sizes, F.lit(0)).cast("bigint")


def project(value: Column, fields: Fields, lenient: bool = False) -> list[Column]:
    return [get(value, path, type_, lenient).alias(name) for name, (path, type_) in fields.items()]


def flatten(
    pages: DataFrame, endpoint: str, array_path: str, fields: Fields, outer: bool = False, lenient: bool = False,
    keep: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per array element of the endpoint's pages.

    Carries ``api_timestamp`` and the element's ``page_number`` and ``position``, the tie-breaks of latest-wins.
    ``keep`` carries page-level fields along; ``outer`` keeps pages whose array is missing or empty.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    page = F.col("collection_json")
    kept = project(page, keep or {}, lenient)
    typed = None if lenient else _typed_elements(page, array_path, fields)
    rows = pages.filter(F.col("api_endpoint") == endpoint).select(
        F.col("date_inserted").alias("api_timestamp"), "page_number", *kept,
        explode(array_at(page, array_path) if typed is None else typed).alias("position", "element"),
    )
    columns = project(F.col("element"), fields, lenient) if typed is None else [F.col("element")[c].alias(c) for c in fields]
    return rows.select("api_timestamp", *(keep or {}), *columns, "page_number", "position")


def _typed_elements(page: Column, array_path: str, fields: Fields) -> Column | None:
    """The array as typed structs, read out of the page at once; None if a field lies deeper than in the element itself.

    An ``array<variant>`` builds every element as a document of its own, with its own dictionary of keys, before any field is read.
    A page with elements that are no objects is read that way still: their fields are NULL.
    """
    keys = {c: path.removeprefix("$.") for c, (path, _) in fields.items()}
    if not all(re.fullmatch(r"\w+", k) for k in keys.values()) or len({k.lower() for k in keys.values()}) < len(keys):
        return None
    objects = F.forall(F.try_variant_get(page, array_path, "array<struct<_ boolean>>"), lambda e: e.isNotNull())
    at_once = F.variant_get(page, array_path, f"array<struct<{', '.join(f'`{keys[c]}` {type_}' for c, (_, type_) in fields.items())}>>")
    renamed = f"array<struct<{', '.join(f'`{c}` {type_}' for c, (_, type_) in fields.items())}>>"
    one_by_one = F.transform(array_at(page, array_path), lambda e: F.struct(*project(e, fields)))
    return F.when(objects, at_once.cast(renamed)).otherwise(one_by_one)


def flatten_nested(
    pages: DataFrame, endpoint: str, array_path: str, parent: Fields, nested_path: str, child: Fields,
) -> DataFrame:
    """Two-level flattening; parents without children stay, with NULL child fields."""
    parents = pages.filter(F.col("api_endpoint") == endpoint).select(
        F.col("date_inserted").alias("api_timestamp"), "page_number",
        F.posexplode(array_at(F.col("collection_json"), array_path)).alias("position", "element"),
    )
    children = parents.select(
        "api_timestamp", "page_number", "position", *project(F.col("element"), parent),
        F.explode_outer(array_at(F.col("element"), nested_path)).alias("child"),
    )
    return children.select("api_timestamp", *parent, *project(F.col("child"), child), "page_number", "position")


def to_text(value: Column) -> Column:
    """JSON text of a document."""
    return F.to_json(value)
