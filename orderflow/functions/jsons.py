"""JSON expressions."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_map(text):
    """One-level JSON object as a map of texts; nested values keep their JSON text."""
    return F.from_json(text, "map<string,string>")


def text_list(text):
    return F.from_json(text, "array<string>")


def _entries(value, schema, parent):
    """Array expression of (key, value) pairs of one struct; `parent` is a Column or None."""
    parts = []
    for field in schema.fields:
        child, name = value.getField(field.name), F.lit(field.name)
        if isinstance(field.dataType, T.StructType):
            parts.append(_entries(child, field.dataType, name))
        elif isinstance(field.dataType, T.ArrayType):
            parts.append(_array_entries(child, field.dataType.elementType, name))
        else:
            key = name if parent is None else F.concat_ws("_", parent, name)
            parts.append(F.array(F.struct(key.alias("key"), child.cast("string").alias("value"))))
    return F.concat(*[F.coalesce(p, F.array().cast("array<struct<key:string,value:string>>")) for p in parts])


def _array_entries(array, element, name):
    def key(i):
        return F.concat_ws("_", name, i.cast("string"))

    if isinstance(element, T.StructType):
        return F.flatten(F.transform(array, lambda x, i: _entries(x, element, key(i))))
    return F.transform(array, lambda x, i: F.struct(key(i).alias("key"), x.cast("string").alias("value")))


def _key_patterns(schema, parent=None):
    """The keys of a struct, "#" standing for an index."""
    found = []
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, T.StructType):
            found += _key_patterns(kind, field.name)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found += _key_patterns(kind.elementType, f"{field.name}_#")
        elif isinstance(kind, T.ArrayType):
            found.append(f"{field.name}_#")
        else:
            found.append(field.name if parent is None else f"{parent}_{field.name}")
    return found


def keys_may_repeat(schema):
    """Whether two entries of a value can have one key."""
    patterns = _key_patterns(schema)
    shapes = [re.compile(re.escape(p).replace(r"\#", r"\d+")) for p in patterns]
    samples = [p.replace("#", "0") for p in patterns]
    return any(i != k and shapes[i].fullmatch(samples[k]) for i in range(len(patterns)) for k in range(len(patterns)))


def _last_of_key(entries):
    """Of entries with one key the last."""
    keys = F.reverse(F.transform(entries, lambda e: e["key"]))
    return F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == F.size(entries) - i)


def _flat(value, schema):
    # bound as lambda arguments, so each is worked out once however often it is used
    bound = F.transform(F.array(value), lambda v: F.filter(_entries(v, schema, None), lambda e: e["value"].isNotNull()))
    return (F.transform(bound, _last_of_key) if keys_may_repeat(schema) else bound)[0]


def flat_entries(value, schema):
    """A nested value as an array of (key, value) texts.

    A key is the name with its direct parent's name in front; elements of an array carry their
    index. Missing values are left out; of entries with one key the last stays.
    """
    return _flat(F.col(value), schema)


def flat_map(value, schema):
    """`flat_entries` as a map."""
    return F.map_from_entries(flat_entries(value, schema))


def flat_json(text, schema):
    """Flattened map of JSON text with a known schema."""
    return F.map_from_entries(flat_json_entries(text, schema))


def flat_json_entries(text, schema):
    """`flat_entries` of JSON text with a known schema; cheaper than the map where rows are exploded."""
    return _flat(F.from_json(text, schema), schema)
