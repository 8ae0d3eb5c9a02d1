"""Compares a query with its SQL in DuckDB over the same Parquet files."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_plain, v)) + "]"
    return repr(v)


def same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(_plain, r)) for r in df.select(*columns).collect())
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(_plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert ours == theirs
    return len(ours)
