"""Compare a query with its SQL in DuckDB: columns, row counts and values."""

from collections import Counter

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
        return None
    if type(v).__name__.startswith("float") or type(v).__name__ == "Decimal":
        v = float(v)
        return int(v) if v == int(v) else round(v, 9)
    if type(v).__name__.startswith("bool"):
        return bool(v)
    if type(v).__name__.startswith(("int", "uint")):
        return int(v)
    return str(v)


def differences(spark, query, sql, path):
    got = query(spark, path).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    done = con.execute(sql)
    names = [c[0] for c in con.description]
    want = pd.DataFrame(done.fetchall(), columns=names)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    bags = [Counter(tuple(map(plain, r)) for r in x[columns].astype(object).itertuples(index=False)) for x in (got, want)]
    return list((bags[0] - bags[1]).items())[:3], list((bags[1] - bags[0]).items())[:3]
