"""Top-N of windowed results."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Operating point of the ranking job.
TOP_N = 3
RANK_WINDOW_MS = 30_000


def top_n(stats, n=TOP_N, period_ms=RANK_WINDOW_MS, rank_within=("productID", "traffic"), ties="collapse"):
    """The `n` best rows by (orders, totalFee) of each longer window and `rank_within` group.

    `ties="collapse"` keeps one row per (orders, totalFee) pair, the earliest; `"all"` keeps them all
    apart. `rank_within=()` ranks products against each other. The `rank <= n` filter is applied
    inside each map task before the exchange, so a task sends at most n rows per group.
    """
    period = (F.floor(F.col("startWindowTime") / period_ms) * period_ms).alias("rankWindowTime")
    group = ["rankWindowTime", *rank_within]
    rows = stats.select(period, *stats.columns)
    if ties == "collapse":
        rest = [c for c in stats.columns if c not in ("orders", "totalFee", *rank_within)]
        earliest = F.min(F.struct(*sorted(rest, key=lambda c: c != "startWindowTime"))).alias("r")
        rows = rows.groupBy(*group, "orders", "totalFee").agg(earliest).select(
            *group, "orders", "totalFee", "r.*"
        )
    best = W.partitionBy(*group).orderBy(
        F.desc("orders"), F.desc("totalFee"), "startWindowTime", "productID", "traffic"
    )
    ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
    return ranked.select("rankWindowTime", *stats.columns, "rank")
