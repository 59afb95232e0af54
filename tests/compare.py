"""Spark results against DuckDB's on the same tables, column order and row order aside."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=str)


def same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    rel = duck(sf_dir).execute(sql)
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == plain(rel.fetchall(), columns)
