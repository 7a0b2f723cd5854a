"""Different values of a key inside a sliding range of time, and the rules made of them.

A value is in reach of a moment when its last sight is less than `within_ms` before it. Each sight of a value enters
and, `within_ms` later, leaves; the running sum of that along a (key, value) says how many sights are in reach,
so it shows when the value comes into reach (0 to 1) and when it goes out of it (1 to 0). These changes alone, summed
along the key, give the number of different values at every row. No row sees a set, and both sums are taken over
evenly cut slices (`ordered.running_sums`), so a key or a value with most of the rows is spread over tasks.
"""

from pyspark.sql import functions as F

from orderflow.operators.ordered import running_sums

# Places of what happens at one millisecond. A value that goes out of reach does so before others come
# in, and a row sees all sights of its own millisecond.
LEAVES, ENTERS, LOOKS = 0, 1, 2


def values_in_reach(rows, keys, value, within_ms, ct="ct", name="inReach"):
    """Adds the number of different values of a key whose last sight is less than `within_ms` old.

    Null values are not counted, null keys are a key, and rows without a time are left out.
    """
    timed = rows.filter(F.col(ct).isNotNull())
    named = {f"_k{i}": F.col(k) for i, k in enumerate(keys)}
    keyed = timed.select("*", *[c.alias(n) for n, c in named.items()], F.col(ct).cast("bigint").alias("_at"))
    keys = list(named)
    # any number of sights in a millisecond is one
    sights = keyed.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"), "_at").distinct()
    both = sights.select("*", F.explode(F.array(F.lit(ENTERS), F.lit(LEAVES))).alias("_kind")).withColumns({
        "_at": F.col("_at") + F.when(F.col("_kind") == LEAVES, within_ms).otherwise(0),
        "_step": F.when(F.col("_kind") == ENTERS, 1).otherwise(-1),
    })
    held = running_sums(both, [*keys, "_value"], ["_at", "_kind"], {"_held": F.col("_step")})
    # in reach from the sight that makes it one to the leave that makes it none
    changes = held.filter((F.col("_held") == 0) | ((F.col("_held") == 1) & (F.col("_step") == 1)))
    changes = changes.select(*keys, "_at", "_kind", "_step")
    looks = keyed.withColumns({"_kind": F.lit(LOOKS), "_step": F.lit(0)})
    along = looks.unionByName(changes, allowMissingColumns=True)
    counted = running_sums(along, keys, ["_at", "_kind"], {"_sum": F.col("_step")})
    return counted.filter(F.col("_kind") == LOOKS).select(*rows.columns, F.col("_sum").cast("bigint").alias(name))


def remote_logins(logins, most=2, within_ms=5 * 60_000, user="userId", region="userRegion", ct="ct"):
    """Logins at which a user has been seen in more than `most` regions within the time, with their number."""
    known = logins.filter(F.col(user).isNotNull())
    return values_in_reach(known, [user], region, within_ms, ct, "regions").filter(F.col("regions") > most)


def many_means(gains, most=2, within_ms=5 * 60_000, user="userId", means="eventType", ct="ct"):
    """Gains of a user who has used more than `most` different means within the time, with their number."""
    known = gains.filter(F.col(user).isNotNull())
    return values_in_reach(known, [user], means, within_ms, ct, "means").filter(F.col("means") > most)
