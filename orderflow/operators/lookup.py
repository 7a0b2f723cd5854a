"""Dimension look-ups that keep the number of fact rows."""

from pyspark.sql import functions as F

from orderflow.schemas import UNMATCHED_HOTEL, UNMATCHED_ONE_DIM, UNMATCHED_PRODUCT
from orderflow.sources.dimensions import last_per_key

# Most dimension rows that are sent to every executor: at about 100 bytes a row, 50 MB.
BROADCAST_ROWS = 500_000


def lookup(facts, dim, key, defaults, version=None, broadcast_rows=BROADCAST_ROWS):
    """Left join of `facts` with one dimension row per key; unmatched rows take `defaults`.

    The dimension is broadcast only after a bounded count shows it has at most `broadcast_rows`
    rows. A larger one is shuffled; adaptive execution cuts the facts of a key that holds a large share of
    them into several tasks.
    """
    columns = list(defaults)
    one = last_per_key(dim.select(key, *columns, *([version] if version else [])), key, version)
    one = one.select(key, *columns, F.lit(True).alias("_found"))
    if dim.select(key).limit(broadcast_rows + 1).count() <= broadcast_rows:
        joined = facts.join(F.broadcast(one), key, "left")
    else:
        joined = facts.join(one.hint("merge"), key, "left")
    filled = {
        c: F.when(F.col("_found"), F.col(c)).otherwise(F.lit(d).cast(dim.schema[c].dataType))
        for c, d in defaults.items()
    }
    return joined.select(*facts.columns, *[v.alias(c) for c, v in filled.items()])


def widen_orders(orders, products, defaults=UNMATCHED_ONE_DIM, **options):
    """Orders with their product attributes."""
    return lookup(orders, products, "productID", defaults, **options)


def widen_orders_two(orders, products, hotels, **options):
    """Orders with their product and hotel attributes."""
    wide = lookup(orders, products, "productID", UNMATCHED_PRODUCT, **options)
    return lookup(wide, hotels, "pubID", UNMATCHED_HOTEL, **options)


def unmatched(facts, dim, key):
    """How many fact rows miss the dimension, per key value."""
    return facts.join(dim.select(key), key, "left_anti").groupBy(key).agg(F.count("*").alias("orders"))
