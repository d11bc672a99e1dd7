"""Order-insensitive comparison of Spark and DuckDB results."""

from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, datetime) and v.time().isoformat() == "00:00:00":
        return v.date().isoformat()
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    return v


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_norm(row[i]) for i in order) for row in rows)


def spark_result(df):
    return multiset(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return multiset([d[0] for d in cur.description], cur.fetchall())
