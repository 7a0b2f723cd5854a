"""Flattening of JSON whose shape is not known, row by row of any shape, with the variant type."""

from pyspark.sql import functions as F

from orderflow.session import stored


def _is(kind):
    return F.startswith(F.schema_of_variant("v"), F.lit(kind))


def _text(value):
    """Scalars as their text, a nested value as its JSON text."""
    return F.when(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), F.to_json(value)).otherwise(value.cast("string"))


def _children(rows, spark):
    """Every member of the objects and arrays in `v`: place `pos`, `key` (null in an array), and the value as `v`."""
    inside = rows.withColumnRenamed("v", "_whole")
    return inside.lateralJoin(spark.tvf.variant_explode(F.col("_whole").outer())).withColumnRenamed("value", "v").drop("_whole")


def flat_entries(rows, keys, text):
    """Rows of `keys`, `key` and `value`: the scalars of JSON objects of any shape, a row each.

    A scalar's key is its name with its direct parent's name in front; members of an array carry the name of the array
    and their index, objects in an array keep that as their parent's name. An array directly inside an array
    stays JSON text, its names in order. Nulls are left out; of entries of one row with one key that of the deepest, last place
    stays. Texts that hold no object give nothing. The columns `keys` tell the rows apart.

    Each level of nesting is one pass over what is nested so far, so the passes are as many as the deepest row has levels
    and each sees only the containers of its level; names and levels are found in the data.
    """
    spark = rows.sparkSession
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    level = rows.select(*[F.col(k).alias(n) for n, k in named.items()], F.try_parse_json(text).alias("v"))
    level = level.filter(_is("OBJECT")).withColumns({"parent": F.lit(None).cast("string"), "path": F.array().cast("array<int>")})
    leaves = []
    while True:
        found = _children(level, spark)
        inside_object = F.col("key").isNotNull()
        index = F.concat_ws("_", "parent", F.col("pos").cast("string"))
        found = found.filter(F.col("v").isNotNull() & ~F.is_variant_null("v")).select(
            *named, "v", "parent", inside_object.alias("in_object"), F.when(inside_object, F.col("key")).otherwise(index).alias("name"),
            F.concat("path", F.array("pos")).alias("path"),
            (_is("OBJECT") | (_is("ARRAY") & inside_object)).alias("nested"),
        )
        found = stored(found, "level")
        leaves.append(found.filter("NOT nested").select(
            *named, "path", _text(F.col("v")).alias("value"),
            F.when(F.col("in_object"), F.concat_ws("_", "parent", "name")).otherwise(F.col("name")).alias("key"),
        ))
        level = found.filter("nested").select(*named, "v", F.col("name").alias("parent"), "path")
        if level.isEmpty():
            break
    entries = leaves[0]
    for more in leaves[1:]:
        entries = entries.unionByName(more)
    last = entries.filter(F.col("value").isNotNull()).groupBy(*named, "key").agg(F.max_by("value", "path").alias("value"))
    return last.select(*[F.col(n).alias(k) for n, k in named.items()], "key", "value")
