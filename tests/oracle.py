"""A query's rows against DuckDB's rows of its SQL, compared as sorted text."""

from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def text(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if v != v else str(int(v)) if v == int(v) else f"{v:.9g}"
    return str(v)


def compare(df, con, sql, empty=False):
    """``empty``: no rows are to be expected; otherwise there have to be some, or nothing is compared."""
    got = df.collect()
    found = con.sql(sql)
    columns = sorted(found.columns)
    assert sorted(df.columns) == columns
    places = [found.columns.index(c) for c in columns]
    assert empty or got
    assert sorted(tuple(text(r[c]) for c in columns) for r in got) == sorted(tuple(text(r[i]) for i in places) for r in found.fetchall())
