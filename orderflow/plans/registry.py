"""All registered queries and their SQL."""

import functools

from orderflow.plans import function_queries, job_queries, live_queries, log_queries, order_queries, stream_queries

_PARTS = (order_queries, log_queries, function_queries, stream_queries, live_queries, job_queries)


def _in_utc(query):
    """Hours and days of the registered queries are those of UTC, whatever the session's zone."""

    # the zone is bound when a plan is made, so the caller's setting can be put back afterwards
    @functools.wraps(query)
    def run(spark, folder):
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return query(spark, folder)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    return run


QUERIES = {name: _in_utc(query) for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
