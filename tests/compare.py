"""Results of Spark and DuckDB side by side."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def both(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    return rows, sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())
