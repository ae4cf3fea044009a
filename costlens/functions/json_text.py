"""Tag texts: validity, the normalised string of Key/Value lists, and pairs of objects or lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_VALUE = "array<struct<Key:string,Value:string>>"
PAIRS = "array<struct<key:string,value:string>>"


def valid_json(text: Column) -> Column:
    """The text itself where it is JSON, else null."""
    return F.when(F.try_parse_json(text).isNotNull(), text)


def tag_string(tags: Column) -> Column:
    """``Key=Value`` of a JSON list of Key/Value objects, by key, then value with nulls last, joined by semicolons.

    Objects without a key are left out, a null value is empty; anything that is not such a list gives null.
    """
    items = F.filter(F.from_json(tags, KEY_VALUE), lambda t: t["Key"].isNotNull())
    # nulls sort first in structs, so the flag of a missing value goes before it
    keyed = F.transform(items, lambda t: F.struct(t["Key"].alias("k"), t["Value"].isNull().alias("none"), F.coalesce(t["Value"], F.lit("")).alias("v")))
    return F.nullif(F.array_join(F.transform(F.array_sort(keyed), lambda t: F.concat(t["k"], F.lit("="), t["v"])), ";"), F.lit(""))


def tag_pairs(tags: Column) -> Column:
    """Pairs of a tag text: of an object in its order; of a list, of its objects. Other texts have none.

    An object of a list that has both ``key`` and ``value`` gives that pair once for each of its entries. Items of a list
    that are no objects are passed over. A null value is the text ``None``, but null in such a pair; other values are JSON.
    """
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    entry = lambda e: pair(e["key"], F.coalesce(e["value"], F.lit("None")))
    of_object = F.transform(F.map_entries(F.from_json(tags, "map<string,string>")), entry)

    def of_item(item: Column) -> Column:
        both = F.map_contains_key(item, F.lit("key")) & F.map_contains_key(item, F.lit("value"))
        return F.transform(F.map_entries(item), lambda e: F.when(both, pair(item["key"], item["value"])).otherwise(entry(e)))

    # a string item may look like an object, so the kind of an item is asked of the parsed list
    parsed = F.try_variant_get(F.try_parse_json(tags), "$", "array<variant>")
    objects = F.filter(F.from_json(tags, "array<string>"), lambda _, i: F.schema_of_variant(F.get(parsed, i)).startswith("OBJECT"))
    items = F.transform(objects, lambda item: F.from_json(item, "map<string,string>"))
    of_list = F.flatten(F.transform(items, of_item))
    empty = F.array().cast(PAIRS)
    return F.when(F.trim(tags).startswith("["), F.coalesce(of_list, empty)).otherwise(F.coalesce(of_object, empty))
