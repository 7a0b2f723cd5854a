"""Side-by-side run of a registered query and its SQL."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(rows, columns):
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(repr(tuple(r[i] for i in at)) for r in rows)


def differences(spark_df, con, sql, show=3):
    """None when both results hold the same rows, else a short text."""
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    want_names, want = canonical(found.fetchall(), columns)
    got_names, got = canonical([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if want_names != got_names:
        return f"columns {got_names} instead of {want_names}"
    if want == got:
        return None
    extra, missing = [r for r in got if r not in set(want)][:show], [r for r in want if r not in set(got)][:show]
    return f"{len(got)} rows instead of {len(want)}; extra {extra}; missing {missing}"
