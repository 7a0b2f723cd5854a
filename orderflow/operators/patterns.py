"""Repeated-event patterns over event time (batch forms).

Rows are put into stretches of time, each with a margin as long as the pattern, so every stretch
can be worked on by its own task although the pattern may run across all users. Where a stretch is
too full for one task, the whole is done with running sums over evenly cut slices instead. Matches
are counted from positions and running sums; pairs of rows are never formed.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.operators.logs import abnormal_duration
from orderflow.operators.ordered import range_slices, running_over_positions, running_sums, sums_over_slices
from orderflow.schemas import ALERT

# The operating point of the alert rule.
TIMES = 3
WITHIN_MS = 5 * 60_000
# Length of a time stretch in pattern lengths; a quarter of the rows is copied into a margin.
SPAN = 8
# Most rows one stretch may hold before the rows are cut by position instead.
STRETCH_ROWS = 5_000_000


def with_stretches(rows, ct, within_ms, after=True, span=SPAN):
    """Copies each row into every time stretch whose margin it falls in; `_own` marks the original."""
    width = span * within_ms
    home = F.floor(F.col(ct) / width)
    seen_by = [home, F.floor((F.col(ct) + within_ms) / width)]
    if after:
        seen_by.append(F.floor((F.col(ct) - within_ms) / width))
    copies = rows.withColumn("_stretch", F.explode(F.array_distinct(F.array(*seen_by))))
    return copies.withColumn("_own", F.col("_stretch") == home)


def _too_full(placed, part, limit):
    return (placed.groupBy(*part).count().agg(F.max("count")).first()[0] or 0) > limit


def _expiring(rows, time, within_ms):
    """Each row twice: when it enters (`_gone` 0) and when it falls out of reach (`_gone` 1).

    Ordered by (`_at`, `_enters`) a row leaves before another one enters at the same time: the reach
    is exclusive.
    """
    both = rows.withColumn("_gone", F.explode(F.array(F.lit(0), F.lit(1))))
    return both.withColumns({"_at": F.col(time) + F.col("_gone") * within_ms, "_enters": 1 - F.col("_gone")})


def _match_terms(times):
    """Values of a leaving row: its reach, and the number of matches it starts."""
    gone = F.col("_gone") == 1
    started = F.greatest(F.col("_reach") - F.col("_pos") - (times - 2), F.lit(0))
    return {"_r": F.when(gone, F.col("_reach")).otherwise(F.lit(0)), "_m": F.when(gone, started).otherwise(F.lit(0))}


def _match_count(times):
    """Matches an entering row is in.

    Starts up to q = pos - times + 1 give one match for each end from this row to their reach; later
    starts give all the matches they start. `_left` rows are out of reach, `_r_left` and `_m_left`
    are their sums; `_r_q` and `_m_q` are the sums up to q, `_m_p` up to this row.
    """
    q = F.col("_pos") - (times - 1)
    long_before = F.when(
        q > F.col("_left"),
        F.col("_r_q") - F.col("_r_left") - (q - F.col("_left")) * (F.col("_pos") - 1),
    ).otherwise(0)
    return long_before + F.col("_m_p") - F.greatest(F.col("_m_left"), F.col("_m_q"))


def repeat_matches(rows, hit, times=TIMES, within_ms=WITHIN_MS, keys=(), ct="ct", order=("seq",), span=SPAN,
                   stretch_rows=STRETCH_ROWS):
    """The rows that take part in a match, each with `matches`, the number of matches it is in.

    A match is a run of at least `times` consecutive rows that all satisfy `hit`, the last less
    than `within_ms` after the first; every sub-run that qualifies is a match of its own.
    Without `keys` "consecutive" means over all rows.
    """
    # without a time a row is in no run, whichever form counts
    base = rows.filter(F.col(ct).isNotNull()).select("*", F.coalesce(hit, F.lit(False)).alias("_hit"))
    placed = with_stretches(base, ct, within_ms, span=span)
    if _too_full(placed, [*keys, "_stretch"], stretch_rows):
        counted = _matches_by_position(base, times, within_ms, list(keys), ct, list(order))
    else:
        counted = _matches_by_stretch(placed, times, within_ms, [*keys, "_stretch"], ct, order)
    return counted.filter("matches > 0").select(*rows.columns, "matches")


def _matches_by_stretch(placed, times, within_ms, part, ct, order):
    """One exchange: all windows share the partitioning by key and stretch."""
    in_order = W.partitionBy(*part).orderBy(ct, *order).rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = placed.withColumn("_run", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(in_order)).filter("_hit")
    part = [*part, "_run"]
    runs = runs.withColumn("_pos", F.row_number().over(W.partitionBy(*part).orderBy(ct, *order)))

    by_time = W.partitionBy(*part).orderBy("_at", "_enters", "_pos")
    so_far = by_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    both = _expiring(runs, ct, within_ms)
    both = both.withColumns({"_reach": F.sum("_enters").over(so_far), "_left": F.sum("_gone").over(so_far)})
    both = both.withColumns(_match_terms(times))
    both = both.withColumns({"_r_left": F.sum("_r").over(so_far), "_m_left": F.sum("_m").over(so_far)})

    by_pos = W.partitionBy(*part).orderBy("_pos", "_gone")
    upto = by_pos.rowsBetween(W.unboundedPreceding, W.currentRow)
    both = both.withColumns({"_r_all": F.sum("_r").over(upto), "_m_all": F.sum("_m").over(upto)})
    # entering and leaving rows alternate, so the leaving row of q is this many rows back
    back = 2 * (times - 1) - 1
    both = both.withColumns({
        "_r_q": F.coalesce(F.lag("_r_all", back).over(by_pos), F.lit(0)),
        "_m_q": F.coalesce(F.lag("_m_all", back).over(by_pos), F.lit(0)),
        "_m_p": F.lead("_m_all", 1).over(by_pos),
    })
    return both.filter("_gone = 0 AND _own").withColumn("matches", _match_count(times))


def _matches_by_position(base, times, within_ms, keys, ct, order):
    """The same sums along evenly cut slices, for stretches that are too full."""
    runs = running_sums(base, keys, [ct, *order], {"_run": F.when(F.col("_hit"), 0).otherwise(1)}).filter("_hit")
    # moved apart by run, rows of different runs are never within reach of each other
    runs = runs.withColumn("_moved", F.col(ct) + F.col("_run") * within_ms)
    by_time = ["_at", "_enters", ct, *order]
    sliced = range_slices(_expiring(runs, "_moved", within_ms), keys, by_time)
    both = sums_over_slices(sliced, by_time, {"_reach": F.col("_enters"), "_left": F.col("_gone")})
    # rows leave in the order they came, so counting them numbers them
    both = both.withColumn("_pos", F.when(F.col("_gone") == 1, F.col("_left")).otherwise(F.col("_reach")))
    both = both.withColumns(_match_terms(times))
    both = sums_over_slices(both, by_time, {"_r_left": F.col("_r"), "_m_left": F.col("_m")})

    # A leaving row counts at its own position and again where it becomes the start q.
    twice = F.explode(F.array(F.lit(False), F.lit(True)))
    gone = both.filter("_gone = 1").select(*keys, "_pos", "_r", "_m", twice.alias("_late"))
    terms = gone.select(
        *keys, (F.col("_pos") + F.when(F.col("_late"), times - 1).otherwise(0)).alias("_pos"),
        F.when(~F.col("_late"), F.col("_m")).otherwise(0).alias("_m_now"),
        *[F.when(F.col("_late"), F.col(c)).otherwise(0).alias(f"{c}_late") for c in ("_r", "_m")],
        F.lit(1).alias("_gone"),
    )
    placed = both.filter("_gone = 0").unionByName(terms, allowMissingColumns=True)
    placed = running_over_positions(
        placed, keys, "_pos",
        {n: F.coalesce(F.col(c), F.lit(0)) for n, c in (("_m_p", "_m_now"), ("_r_q", "_r_late"), ("_m_q", "_m_late"))},
        block=100_000, peers=True,
    )
    return placed.filter("_gone = 0").withColumn("matches", _match_count(times))


def repeat_events(rows, hit, times=TIMES, within_ms=WITHIN_MS, keys=(), ct="ct", order=("seq",), span=SPAN,
                  stretch_rows=STRETCH_ROWS):
    """Rows satisfying `hit` that are at least the `times`-th such row within `within_ms`, other rows
    in between allowed; `inWindow` is the number of such rows up to and including this one."""
    hits = rows.filter(hit & F.col(ct).isNotNull())
    placed = with_stretches(hits, ct, within_ms, after=False, span=span)
    part = [*keys, "_stretch"]
    by_time = ["_at", "_enters", ct, *order]
    if _too_full(placed, part, stretch_rows):
        both = _expiring(hits, ct, within_ms).withColumn("_own", F.lit(True))
        both = running_sums(both, list(keys), by_time, {"_pos": F.col("_enters"), "_left": F.col("_gone")})
    else:
        so_far = W.partitionBy(*part).orderBy(*by_time).rowsBetween(W.unboundedPreceding, W.currentRow)
        both = _expiring(placed, ct, within_ms)
        both = both.withColumns({"_pos": F.sum("_enters").over(so_far), "_left": F.sum("_gone").over(so_far)})
    counted = both.filter("_gone = 0 AND _own").withColumn("inWindow", F.col("_pos") - F.col("_left"))
    return counted.filter(F.col("inWindow") >= times).select(*rows.columns, "inWindow")


def duration_matches(views, low=5, high=50, **options):
    """Page views in runs of abnormal stays, with their match counts."""
    return repeat_matches(views, abnormal_duration(low, high), **options)


def alerts(matches, repeat=False):
    """Alert records: one per row that is in a match, with `matches`, the number of matches it is in. With
    `repeat` a row comes once for each of them instead; their number grows with the square of a run, so ask for it
    only where runs are short."""
    extra = [] if repeat else ["matches"]
    if repeat:
        matches = matches.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("matches"))))
    renames = {"userRegionIp": "userRegionIP"}
    return matches.select(*[F.col(renames.get(n, n)).alias(n) for n in ALERT.fieldNames()], *extra)
