"""Row comparison of a Spark result with DuckDB SQL."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return int(v) if float(v).is_integer() else float(v)
    return str(v)


def key(row):
    """Rows in one order on both sides: by what is exact first, then by rounded numbers."""
    return [str(v) for v in row if not isinstance(v, float)], [f"{v:.6g}" for v in row if isinstance(v, float)]


def check(df, con, sql):
    rel = con.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    place = {c: i for i, c in enumerate(rel.columns)}
    theirs = sorted((tuple(plain(r[place[c]]) for c in columns) for r in rel.fetchall()), key=key)
    assert len(mine) == len(theirs)
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b and not close(a, b)]
    assert not bad, bad[:3]


def close(a, b):
    """Equal but for 1e-9 relative."""
    for x, y in zip(a, b):
        if x != y and (isinstance(x, str) or isinstance(y, str) or not math.isclose(x, y, rel_tol=1e-9)):
            return False
    return True
