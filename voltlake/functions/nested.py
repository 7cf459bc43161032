"""Expressions over nested records.

An absent key and a key holding null must stay different. A record with unknown keys is a
``map<string,string>``. A record with declared keys is a struct of variants, which the JSON
parser fills without touching other keys: an absent key is null there, a key holding null is a
variant null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltlake.constants import MISSING

RECORD = "map<string,string>"
RECORDS = "array<map<string,string>>"


def field(record: Column, key: str, default: str | None = None) -> Column:
    """Value of ``key``: ``default`` if the key is absent, null if it holds null."""
    if default is None:
        return F.try_element_at(record, F.lit(key))
    return F.when(
        F.map_contains_key(record, key), F.try_element_at(record, F.lit(key))
    ).otherwise(F.lit(default))


def default_for(key: str, fill: str | None | Mapping[str, str | None]) -> str | None:
    """Default of ``key``; with defaults per key, a key without one is an error."""
    if isinstance(fill, Mapping):
        if key not in fill:
            raise KeyError(f"no default for key {key!r}")
        return fill[key]
    return fill


def fields(
    record: Column, keys: list[str], fill: str | None | Mapping[str, str | None] = MISSING
) -> list[Column]:
    """One aliased column per key."""
    return [field(record, key, default_for(key, fill)).alias(key) for key in keys]


def record_type(keys: list[str], **nested: str) -> str:
    """Struct of variants for ``keys``; ``nested`` gives further members with their type."""
    members = [f"`{k}`:variant" for k in keys if k not in nested]
    members += [f"`{k}`:{kind}" for k, kind in nested.items()]
    return f"struct<{','.join(members)}>"


def text_of(value: Column, default: str | None = None) -> Column:
    """Text of a variant: ``default`` if the key was absent, null if it held null."""
    text = value.cast("string")
    return text if default is None else F.when(value.isNull(), F.lit(default)).otherwise(text)


def texts(
    record: Column, keys: list[str], fill: str | None | Mapping[str, str | None] = MISSING
) -> list[Column]:
    """One aliased text column per declared key of a struct of variants."""
    return [text_of(record[key], default_for(key, fill)).alias(key) for key in keys]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Inside a lambda nothing else keeps a repeated subexpression from being repeated.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def computed_once(array: Column) -> Column:
    """The same array or map, worded for ``explode`` and ``inline``.

    Given a bare column these let the optimizer add a "size > 0" filter and push it below the
    projection that made the column, so parsing would run once for the filter and again for
    the rows.
    """
    return F.when(array.isNotNull(), array)


def truthy(value: Column) -> Column:
    """Truth of a variant by its kind: text, lists and objects are true unless empty, so the text
    ``false`` is true; numbers unless zero. Absent and null are false."""
    kind, text = F.schema_of_variant(value), value.cast("string")
    truth = (
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(text.try_cast("double") != 0)
    )
    return F.coalesce(truth, F.lit(False))


def is_last_of_key(keys: Column) -> Column:
    """For an array of keys, an array of booleans: is this the key's last occurrence?

    Sorting the (key, position) pairs puts equal keys side by side, so the whole array costs
    n log n inside its row and no shuffle.
    """
    pairs = F.sort_array(
        F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("pos")))
    )
    following = F.concat(
        F.slice(pairs, F.lit(2), F.greatest(F.size(pairs), F.lit(1))),
        F.array(F.lit(None).cast("struct<key:string,pos:int>")),
    )
    flagged = F.zip_with(
        pairs,
        following,
        lambda here, after: F.struct(
            here["pos"].alias("pos"),
            (after.isNull() | ~here["key"].eqNullSafe(after["key"])).alias("last"),
        ),
    )
    by_position = F.sort_array(F.filter(flagged, lambda x: x["pos"].isNotNull()))
    return F.transform(by_position, lambda x: x["last"])
